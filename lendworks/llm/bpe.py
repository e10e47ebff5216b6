"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary is a file of byte ranks. It is turned into a tokenizers BPE model: every byte is written as
its printable character, and a token's merges are all its splits into two tokens of lower rank, in rank
order. That gives the ids of a greedy lowest-rank merge inside each match of the split pattern.

Defined results: a null text is encoded as the empty text (no ids, empty bytes). Ids decode to the exact
bytes of the text; as text, bytes that form no character become U+FFFD, which only happens when ids are cut
inside a character. Rows are handled one by one, so repeated rows give repeated results, and an empty table
an empty one. Columns of the input that have an added column's name are replaced.
"""

from __future__ import annotations

import base64
import codecs
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lendworks.llm.batches import bounded_batches, slices, texts_of
from lendworks.llm.pieces import BYTE_CHARACTERS, PieceCache, as_byte_characters, packed_ids

#: Fixed value: the split pattern that this module knows. Others are honoured, at the library's own pace.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of ASCII and Latin-1 letters only; for these SIMPLE_SPLIT equals KNOWN_PATTERN.
SIMPLE_TEXT = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*").fullmatch
SIMPLE_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+"
).findall
#: Other texts go to the library in parts of about so many characters, cut between a non-space and a space.
PART_CHARS = 200_000


class Codec:
    """Encoder and decoder of one rank file; one per Python worker."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        shown = {token: token.decode("latin-1").translate(BYTE_CHARACTERS) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.get):
            for cut in range(1, len(token)):
                left, right = token[:cut], token[cut:]
                if max(ranks.get(left, len(ranks)), ranks.get(right, len(ranks))) < ranks[token]:
                    merges.append((shown[left], shown[right]))
        vocab = {shown[token]: rank for token, rank in ranks.items()}
        self.model = models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0)
        self.tokenizer = Tokenizer(self.model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        size = max(ranks.values()) + 1
        self.bytes_of = [b""] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.lengths = np.array([len(t) for t in self.bytes_of], np.int64)
        self.pieces = PieceCache(self._piece)
        self.known = pattern == KNOWN_PATTERN

    def _piece(self, piece: str) -> bytes:
        return packed_ids([t.id for t in self.model.tokenize(as_byte_characters(piece))])

    def encode(self, text: str) -> np.ndarray:
        if self.known and SIMPLE_TEXT(text):
            packed = self.pieces.ids(SIMPLE_SPLIT(text))
        else:
            # Where another pattern's matches end is not known, so its texts are not cut.
            cut = parts(text) if self.known else [text]
            packed = b"".join(packed_ids(self.tokenizer.encode(part, add_special_tokens=False).ids) for part in cut)
        return np.frombuffer(packed, np.uint32).astype(np.int32)

    def starts(self, text: str, ids: np.ndarray) -> np.ndarray:
        """For each token the character that its first byte belongs to."""
        ends = np.cumsum(self.lengths[ids])
        at = ends - self.lengths[ids]
        if text.isascii():
            return at.astype(np.int32)
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return character[at].astype(np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_stream(self, chunks: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of successive id chunks; a character split over chunks appears with the chunk that ends it."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for chunk in chunks:
            yield decoder.decode(self.decode(chunk))
        yield decoder.decode(b"", final=True)


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text before a space or newline that follows a non-space, where no match of the pattern spans."""
    at = 0
    while len(text) - at > size:
        cut = re.compile(r"(?<=\S)(?=[ \n])").search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _added(df: DataFrame, names: Iterable[str]) -> list[str]:
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = True, decoded: bool = False
) -> DataFrame:
    """Add ``token_ids`` and, if asked, ``token_starts`` (characters) and ``decoded`` (bytes, from the ids)."""
    bounded_batches(df.sparkSession)
    names = ["token_ids", *["token_starts"] * offsets, *["decoded"] * decoded]
    kinds = {"token_ids": "array<int>", "token_starts": "array<int>", "decoded": "binary"}
    kept = _added(df, names)
    source = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("_text"))
    schema = T.StructType(
        [*(df.schema[c] for c in kept), *(T.StructField(n, T._parse_datatype_string(kinds[n])) for n in names)]
    )
    last = len(kept)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_codec = codec(path, pattern)
        for batch in slices(batches, last):
            found = texts_of(batch.column(last))
            ids = [with_codec.encode(t) for t in found]
            columns = [*batch.columns[:last], _lists(ids)]
            if offsets:
                columns.append(_lists([with_codec.starts(t, i) for t, i in zip(found, ids)]))
            if decoded:
                columns.append(pa.array([with_codec.decode(i.tolist()) for i in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """Add ``decoded`` (bytes) and ``decoded_text`` for the ids of each row; null ids count as none."""
    bounded_batches(df.sparkSession)
    names = ["decoded", "decoded_text"]
    kept = _added(df, names)
    source = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{ids}`").cast("array<int>").alias("_ids"))
    schema = T.StructType(
        [*(df.schema[c] for c in kept), T.StructField("decoded", T.BinaryType()), T.StructField("decoded_text", T.StringType())]
    )
    last = len(kept)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_codec = codec(path, pattern)
        for batch in slices(batches, last):
            raw = [with_codec.decode(i or ()) for i in batch.column(last).to_pylist()]
            text = [b.decode("utf-8", "replace") for b in raw]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array(raw, pa.binary()), pa.array(text, pa.string())], [*kept, *names]
            )

    return source.mapInArrow(run, schema)
