from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lendworks.llm import token_store
from lendworks.llm.queries import QUERIES, WORD_BPE
from lendworks.staging import Stage
from tests.llm.helpers import awkward, documents, none


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_equal_the_library(tokenizer):
    encoder = token_store.WordEncoder(WORD_BPE)
    rng = random.Random(4)
    letters = "aAbÉéß ñ\n\t'sxX19 .!?$% 中日本語한\U0001f600́ \x1cªµº  tThHeE<|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3_000)]
    for text in [*texts, "", " ", "<|endoftext|> IT'S", "foo <|endoftext|> bar", "日本<|startoftext|>x", "<|EndOfText|>", "İstanbul ΣΑΣ", "日本 x " * 60_000]:
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_another_tokenizer_file_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), token_store.WordEncoder(path)
    for text in ("It's Foo\n\n  bar 1234 ", "日本 <|endoftext|> x", "Ünï", ""):
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("largest", [200, 60_000, 2**32 - 1])
def test_any_token_is_read_directly(largest):
    rng = np.random.default_rng(largest)
    counts = [0, 700, 1, 5_000, 0, 33]
    ids = (rng.random(sum(counts)) ** 4 * largest).astype(np.uint32)
    segment = token_store.Segment(token_store.pack([5, None, 7, 8, 9, -1], counts, ids))
    assert segment.ids().tolist() == ids.tolist()
    assert [segment[i] for i in range(len(ids))] == ids.tolist()
    assert segment.starts.tolist() == [0, 0, 700, 701, 5701, 5701, 5734]
    with pytest.raises(IndexError):
        segment[len(ids)]


def test_no_ids_at_all():
    segment = token_store.Segment(token_store.pack([1], [0], np.zeros(0, np.uint32)))
    assert segment.ids().tolist() == [] and len(segment) == 0


def stored(spark, docs, **options):
    folder = Stage(spark).folder("tokens")
    token_store.write_tokens(docs, folder, WORD_BPE, end_id=1)
    return token_store.read_tokens(spark, folder, **options).collect()


def expected(tokenizer, rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_documents_in_order(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT_IDS", 100)
    monkeypatch.setattr(token_store, "FILE_IDS", 250)
    rows = [(i * 7 % 501, f"Text number {i} of many " * (i % 9)) for i in range(501)]
    found = stored(spark, documents(spark, rows))
    assert sorted((tuple(r) for r in found), key=lambda r: r[1]) == expected(tokenizer, rows)


def test_awkward_rows_and_empty_table(spark, tokenizer):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = stored(spark, docs, with_ids=True)
    assert sorted(r["n_tokens"] for r in found) == sorted(n for _, _, n, _ in expected(tokenizer, rows))
    in_order = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in in_order] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(in_order, in_order[1:]))
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    assert stored(spark, none(spark)) == []


def test_query_against_the_library(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op7_token_files"](spark, sf).collect()), key=lambda r: r[1]) == expected(tokenizer, rows)
