from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from lendworks.llm import bpe
from lendworks.llm.queries import BPE_RANKS, QUERIES, bpe_digests
from tests.llm.helpers import awkward, documents, none

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def samples() -> list[str]:
    rng = random.Random(5)
    letters = "aabé ñ\n\t'sx1 .!?$% 中日本語한\U0001f600́ \x1cAbC  reedt<|>"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3_000)]
    return [*made, "", " ", "\n\n  x", "a" * 5_000, " " * 3_000, "<|endoftext|> it's WE'LL", "tab\t\n two\x0b"]


def test_ids_equal_the_other_library(reference):
    codec = bpe.codec(BPE_RANKS, PATTERN)
    for text in samples():
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)


def test_other_patterns_are_honoured(reference):
    own = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=reference._mergeable_ranks, special_tokens={})
    codec = bpe.codec(BPE_RANKS, r"\S+|\s+")
    texts = [*samples()[:800], "It's plain, isn't it?  Yes.", "日本 x " * 50_000]
    for text in texts:
        assert codec.encode(text).tolist() == own.encode_ordinary(text)
    assert any(codec.encode(t).tolist() != reference.encode_ordinary(t) for t in texts)


def test_long_texts_in_parts_give_the_same_ids(reference):
    codec = bpe.codec(BPE_RANKS, PATTERN)
    text = "日本 word, and\n  more \t things " * 3_000
    assert "".join(bpe.parts(text, 1_000)) == text and len(list(bpe.parts(text, 1_000))) > 10
    assert [i for p in bpe.parts(text, 1_000) for i in codec.encode(p).tolist()] == reference.encode_ordinary(text)


def test_starts_follow_characters_and_split_characters_decode():
    codec = bpe.codec(BPE_RANKS, PATTERN)
    text = "é \U0001f600 日本語 ok"
    ids = codec.encode(text)
    owner = [n for n, character in enumerate(text) for _ in character.encode()]  # the character of each byte
    at, expected = 0, []
    for i in ids.tolist():
        expected.append(owner[at])
        at += len(codec.bytes_of[i])
    assert codec.starts(text, ids).tolist() == expected
    assert codec.decode(ids.tolist()).decode() == text
    assert "".join(codec.decode_stream([i] for i in ids.tolist())) == text


def test_round_trip_on_awkward_rows(spark):
    docs = awkward(spark)
    encoded = bpe.encode(docs, BPE_RANKS, PATTERN)
    assert set(encoded.columns) == {*docs.columns, "token_ids", "token_starts"}
    back = bpe.decode(encoded, BPE_RANKS, PATTERN).select("text", "decoded", "decoded_text", "token_ids").collect()
    assert len(back) == docs.count()
    for row in back:
        assert row["decoded_text"] == (row["text"] or "") and bytes(row["decoded"]).decode() == (row["text"] or "")
        assert bool(row["token_ids"]) == bool(row["text"])


def test_empty_table(spark):
    assert bpe.encode(none(spark), BPE_RANKS, PATTERN, decoded=True).collect() == []


def test_digests(spark, reference):
    docs = documents(spark, [(1, "Hello wörld"), (2, None)])
    found = {r["doc_id"]: r for r in bpe_digests(bpe.encode(docs, BPE_RANKS, PATTERN, decoded=True)).collect()}
    for i, text in ((1, "Hello wörld"), (2, "")):
        ids = reference.encode_ordinary(text)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_query_against_the_other_library(spark, reference):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op1_byte_bpe"](spark, sf).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = reference.encode_ordinary(texts[row["doc_id"]])
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
