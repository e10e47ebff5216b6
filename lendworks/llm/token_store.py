"""Token ids in files of directly addressable codes.

An id is cut into chunks of a byte each, lowest first. Level k of a segment holds the k-th chunk of every id
that has one, a bitmap that tells whether the id goes on in the next level, and a directory of the bitmap's
ranks. Token i is read by one look at each level: its chunk, its bit, and the rank of that bit, which is the
token's place in the next level. No block is decoded for it.

Files are written by Spark's own writer, so a lost executor or a repeated task leaves no half file: a file is
a header, segments, and a newline. Segments follow ascending document ids, nulls first, over all files.

Defined results: a null text counts as empty and holds the end id alone. Rows of one id are stored one after
the other, by text. An empty table makes no segment and an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lendworks.llm.batches import bounded_batches, slices, texts_of
from lendworks.llm.bpe import parts
from lendworks.llm.pieces import CACHE_PIECES, PieceCache, as_byte_characters, packed_ids
from lendworks.staging import Stage

MAGIC = b"DACTOK01"
FILE_MAGIC = b"DACFILE1"
#: Header of a segment (magic, documents, ids, levels) and of a file (magic, documents, ids, segments);
#: big-endian, so that SQL can read the counts.
HEADER = struct.Struct(">8sQQQ")
RANK_BITS = 512
#: Ids in a segment and in a file at most, unless one document alone has more.
SEGMENT_IDS = 1_000_000
FILE_IDS = 8_000_000

#: The normaliser's and splitter's steps, as a tokenizer file states them, that this module knows.
#: Files with others are read by the library alone.
KNOWN_STEPS = {
    "normalizer": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "pre_tokenizer": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Lower-cased texts of ASCII and Latin-1 letters; their split is that splitter's pattern over them.
SIMPLE_TEXT = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*").fullmatch
SIMPLE_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+"
).findall


class WordEncoder:
    """Ids of a tokenizer file as the library gives them, one per Python worker.

    Strings of the file's added tokens become those tokens, which is the library's default.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = PieceCache(self._piece, 2 * CACHE_PIECES)
        stated = json.loads(self.tokenizer.to_str())
        steps = {"normalizer": "normalizers", "pre_tokenizer": "pretokenizers"}
        self.known = all((stated[k] or {}).get(inner) == KNOWN_STEPS[k] for k, inner in steps.items())
        self.added = [t["content"].lower() for t in stated["added_tokens"]]

    def _piece(self, piece: str) -> bytes:
        return packed_ids([t.id for t in self.model.tokenize(as_byte_characters(piece))])

    def encode(self, text: str) -> bytes:
        lowered = text.lower()
        if not self.known or any(t in lowered for t in self.added):
            return packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if SIMPLE_TEXT(text):
            return self.pieces.ids(SIMPLE_SPLIT(lowered))
        return b"".join(
            packed_ids(self.tokenizer.encode(p, add_special_tokens=False).ids) for p in parts(text)
        )


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A segment: header, documents (id, whether null, first token), then the levels."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest > 0xFF
        levels.append(((rest & 0xFF).astype(np.uint8), goes_on))
        rest = rest[goes_on] >> 8
        if not len(rest):
            break
    out = [HEADER.pack(MAGIC, len(doc_ids), len(ids), len(levels))]
    out.append(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    out.append(np.array([d is None for d in doc_ids], "u1").tobytes())
    out.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes())
    for chunks, goes_on in levels:
        padded = np.zeros(-(-len(goes_on) // RANK_BITS) * RANK_BITS, bool)
        padded[: len(goes_on)] = goes_on
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1))])
        out += [
            struct.pack(">Q", len(chunks)),
            chunks.tobytes(),
            np.packbits(padded, bitorder="little").tobytes(),
            ranks.astype("<u8").tobytes(),
        ]
    return b"".join(out)


class Segment:
    """A packed segment; its arrays are views on the bytes."""

    def __init__(self, data: bytes, at: int = 0):
        magic, self.documents, self.length, levels = HEADER.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self._at = at + HEADER.size
        self._data = data
        self.doc_ids = self._take("<i8", self.documents)
        self.null_ids = self._take("u1", self.documents)
        self.starts = self._take("<u8", self.documents + 1)
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from(">Q", data, self._at)
            self._at += 8
            blocks = -(-n // RANK_BITS)
            self.levels.append(
                (self._take("u1", n), self._take("u1", blocks * RANK_BITS // 8), self._take("<u8", blocks + 1))
            )

    def _take(self, kind: str, n: int) -> np.ndarray:
        found = np.frombuffer(self._data, kind, n, self._at)
        self._at += found.nbytes
        return found

    @property
    def end(self) -> int:
        """Where the bytes of the next segment begin."""
        return self._at

    def __len__(self) -> int:
        return self.length

    def __getitem__(self, i: int) -> int:
        """Token i, by direct addressing."""
        if not 0 <= i < self.length:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            before = bits[block * RANK_BITS // 8 : i >> 3]
            inside = int(np.bitwise_count(before).sum()) + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(ranks[block]) + inside
        return value

    def ids(self) -> np.ndarray:
        """All ids of the segment."""
        higher = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            value[goes_on] |= higher << 8
            higher = value
        return higher


def segments(data: bytes) -> Iterator[Segment]:
    """The segments of a file."""
    magic, _, _, n = HEADER.unpack_from(data)
    if magic != FILE_MAGIC:
        raise ValueError("not a token file")
    at = HEADER.size
    for _ in range(n):
        segment = Segment(data, at)
        at = segment.end
        yield segment


class FileBuilder:
    """Collects documents into segments, and segments into files."""

    def __init__(self) -> None:
        self.names: list[int | None] = []
        self.found: list[bytes] = []
        self.held = self.documents = self.ids = 0
        self.done: list[bytes] = []

    def end_segment(self) -> None:
        if self.found:
            counts = [len(f) // 4 for f in self.found]
            self.done.append(pack(self.names, counts, np.frombuffer(b"".join(self.found), np.uint32)))
            self.documents, self.ids = self.documents + len(counts), self.ids + self.held
            self.names, self.found, self.held = [], [], 0

    def end_file(self) -> Iterator[pa.RecordBatch]:
        self.end_segment()
        if self.done:
            data = b"".join([HEADER.pack(FILE_MAGIC, self.documents, self.ids, len(self.done)), *self.done])
            self.done, self.documents, self.ids = [], 0, 0
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["file"])

    def add(self, name: int | None, ids: bytes) -> Iterator[pa.RecordBatch]:
        n = len(ids) // 4
        if self.held + n > SEGMENT_IDS:
            self.end_segment()
            if self.ids + n > FILE_IDS:
                yield from self.end_file()
        self.names.append(name)
        self.found.append(ids)
        self.held += n


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode all texts and write their ids, ``end_id`` after each, as token files under ``folder``."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )
    # Equal ids are told apart by a hash, so that rows without an id don't meet in one task.
    place = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*place).sortWithinPartitions(*place, "text")
    end = packed_ids([end_id])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, builder = word_encoder(path), FileBuilder()
        for batch in slices(batches, 1):
            for name, value in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                yield from builder.add(name, encoder.encode(value) + end)
        yield from builder.end_file()

    # The text writer puts a string's bytes out as they are; one record makes one file.
    files = dealt.mapInArrow(run, "file binary").select(F.col("file").cast("string").alias("value"))
    files.write.mode("overwrite").option("maxRecordsPerFile", 1).text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """``part, piece, content``: the files in their order."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(
        F.regexp_extract("path", r"part-(\d+)-", 1).cast("long").alias("part"),
        F.regexp_extract("path", r"-c(\d+)[^/]*$", 1).cast("long").alias("piece"),
        "content",
    )


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Per stored document ``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, piece, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                before = 0
                for segment in segments(content):
                    ids, starts = segment.ids().astype("<u4"), segment.starts.astype(np.int64)
                    n = segment.documents
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:])]
                    columns = [
                        pa.array(np.full(n, part)),
                        pa.array(np.full(n, piece)),
                        pa.array(segment.doc_ids, mask=segment.null_ids.astype(bool)),
                        pa.array(before + starts[:-1]),
                        pa.array(np.diff(starts)),
                        pa.array(sums, pa.int64()),
                    ]
                    names = ["part", "piece", "doc_id", "within", "n_tokens", "ids_crc32"]
                    if with_ids:
                        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int64)))
                        columns.append(lists)
                        names.append("ids")
                    before += len(segment)
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = "part long, piece long, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    # Files are opened once: what they hold tells their sizes as well.
    stored = Stage(spark).table("stored", lambda: _files(spark, folder).mapInArrow(run, schema))
    sizes = stored.groupBy("part", "piece").agg(F.sum("n_tokens").alias("n"))
    earlier = lambda window: F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per writing task meets in one window, and that task's files in another.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", earlier(Window.orderBy("part")).alias("before"))
    own = earlier(Window.partitionBy("part").orderBy("piece")).alias("own")
    bases = sizes.select("part", "piece", own).join(parts, "part").select("part", "piece", (F.col("before") + F.col("own")).alias("base"))
    return stored.join(bases, ["part", "piece"]).select(
        "doc_id", (F.col("base") + F.col("within")).cast("long").alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )
