from __future__ import annotations

import hashlib
import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lendworks.llm import line_dedup, mixing, quality
from lendworks.llm.queries import BPE_RANKS
from tests.llm.helpers import awkward, documents, none
from tests.llm.test_bpe import reference  # noqa: F401
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import brute_count
from tests.llm.test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_stage", "line_stage", "near_dedup_stage", "mixing_stage", "bpe_stage",
    ]


def test_run_against_brute_force(spark, reference):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    machine = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = []
    for r in docs.collect():
        if machine.score(*machine.vector(*quality.features(r["text"], r["n_chars"]))) >= quality.THRESHOLD:
            rows.append((r["doc_id"], r["text"], r["source"]))
    source = {i: s for i, _, s in rows}
    cut = brute_lines([(i, t) for i, t, _ in rows], line_dedup.MIN_WORDS)
    kept = {i: t for i, t, gone in cut if not gone or t.strip()}
    groups = brute_groups({i: brute_print(t) for i, t in kept.items()})
    kept = {i: kept[i] for i in sorted(set(groups.values()))}
    sizes: dict[str, int] = {}
    for i in kept:
        sizes[source[i]] = sizes.get(source[i], 0) + 1
    total = sum(n**0.5 for n in sizes.values())
    wanted = []
    for i, text in kept.items():
        n = sizes[source[i]]
        ids = reference.encode_ordinary(text)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        row = (i, len(ids), digest, hashlib.sha256(text.encode()).hexdigest())
        wanted += [row] * brute_count(i, len(kept) * n**0.5 / total / n)
    found = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert len(wanted) > 50 and len(kept) < docs.count()


@pytest.mark.parametrize("make", [awkward, none], ids=["awkward", "none"])
def test_every_stage_copes_with_awkward_documents(spark, make, tmp_path):
    docs = make(spark)
    labels = [(1, 1, 0), (2, None, 1), (None, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns
        assert make is awkward or out.collect() == []
        out.collect()


def test_decisions_take_effect(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"one\n{passage}"), (2, f"two\n{passage}"), (3, passage), (4, ""), (5, "five")]
    found = {r["doc_id"]: r for r in corpus_pipeline.line_stage(spark, documents(spark, rows), "").collect()}
    assert {i: r["text"] for i, r in found.items()} == {1: rows[0][1], 2: "two", 4: "", 5: "five"}
    assert found[2]["n_chars"] == 3
    kept = corpus_pipeline.near_dedup_stage(spark, documents(spark, [(7, "a b c d"), (3, "A b c d"), (9, "other text here")]), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 9]


def test_clean_labelled_documents_pass_the_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = corpus_pipeline.quality_stage(spark, docs, sf).select("doc_id")
    judged = labels.join(kept.withColumn("kept", F.lit(1)), "doc_id", "left").groupBy("quality", "kept").count().collect()
    counts = {(r["quality"], r["kept"]): r["count"] for r in judged}
    assert counts.get((1, None), 0) == 0 and counts.get((0, 1), 0) <= 2


def test_parameters_are_the_stated_ones():
    assert (zlib.crc32(b"1") % quality.FOLDS == 0) is False and quality.THRESHOLD == 0.3
    assert mixing.HASH_BITS == 52 and BPE_RANKS.endswith("byte_bpe_multi_50k.tiktoken")
