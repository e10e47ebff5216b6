"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendworks.llm import bpe, exact, extract, line_dedup, mixing, quality, revisits, runs, simhash, token_store, topk, toxicity, trie
from lendworks.staging import Stage

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN, decoded=True))


def bpe_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.try_element_at("token_starts", F.lit(-1)).alias("last_token_start"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


# Three captures of every page: first seen, seen again under another spelling of its URL, and seen once more.
# By page id, a first capture may be missing, a validator stale, weak or a date, and a page may change.
CAPTURES = """
SELECT page_id * 4 + c AS record_id, page_id, c,
  CASE WHEN c = 0 AND page_id % 11 <> 0 OR c = 2 AND page_id % 5 = 0 THEN 'response' ELSE 'revisit' END AS kind,
  CASE c WHEN 0 THEN url WHEN 1 THEN url || '#again'
    ELSE regexp_replace(url, '[?].*$', '') || '?utm_medium=feed' || CASE WHEN url LIKE '%?%' THEN '&' ELSE '' END
      || regexp_replace(url, '^[^?]*[?]?', '') END AS url,
  1704067200 + (page_id * 37) % 86400 + c * 86400 AS seconds, md5(html) AS sum, html
FROM {pages}
"""


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html", F.explode(F.array(*map(F.lit, range(3)))).alias("c"))
    rows = spark.sql(CAPTURES, pages=pages)
    full = F.col("kind") == "response"
    version = F.when(full & (F.col("c") == 2), "2").otherwise("1")
    tag = F.concat(F.lit('"'), F.col("sum"), F.lit("-"), version, F.lit('"'))
    tag = (
        F.when((F.col("c") > 0) & ~full & (F.col("page_id") % 7 == 3), '"stale"')
        .when(~full & (F.col("page_id") % 3 == 0), F.concat(F.lit("W/"), tag))
        .otherwise(tag)
    )
    dated = ~full & (F.col("page_id") % 13 == 5)

    def line(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    headers = F.array(
        line("Date", F.col("seconds").cast("string")),
        F.when(~dated, line("ETag", tag)),
        line("Last-Modified", F.lit("Mon, 01 Jan 2024 00:00:00 GMT")),
        line("Cache-Control", F.concat(F.lit("max-age="), F.col("c").cast("string"))),
        line("Content-Length", F.when(full, F.length("html").cast("string")).otherwise("0")),
        F.when(full, line("Content-Type", F.lit("text/html"))),
        F.when(full, line("X-Served", F.lit("origin"))),
    )
    return rows.select(
        "record_id",
        "kind",
        "url",
        F.timestamp_seconds("seconds").alias("ts"),
        F.when(full, 200).otherwise(304).alias("status"),
        F.filter(headers, lambda h: h.isNotNull()).alias("headers"),
        F.when(full, F.col("sum")).alias("digest"),
        F.when(full, F.col("html")).alias("payload"),
    )


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(captures(spark, sf_dir))
    seconds = F.unix_seconds("ts").alias("seconds")
    return found.select(
        "record_id", "kind", "canonical_url", seconds, "resolution", "refers_to", "status",
        F.array_join("headers", "\n").alias("headers"), "payload",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = quality.classify(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Stage(spark).folder("tokens")
    token_store.write_tokens(read(spark, sf_dir, "documents"), folder, WORD_BPE, end_id=1)
    return token_store.read_tokens(spark, folder)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(read(spark, sf_dir, "documents"), shingle=3, distance=3)
    return groups.select("doc_id", "fingerprint", "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.classify(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents, a tenth of them (by CRC-32 of the id) with a tail that repeats its first words."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(hashed / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        start = g % F.greatest(n, F.lit(1))
        period = 1 + F.floor((n - start) / (3 + g % 8))
        place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period).cast("int")
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i)))
        return F.when(n > 0, F.array_join(tail, " ")).otherwise("")

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(F.col("text").isNotNull() & (hashed % 10 == 0), F.transform(F.array(words), repeated)[0])
    return docs.withColumn("text", text.otherwise(F.col("text")))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return run_digests(runs.periodic_runs(with_planted_runs(docs), min_length=6, min_exponent=4))


def run_digests(found: DataFrame) -> DataFrame:
    def higher(best: Column, run: Column) -> Column:
        # Runs come by start and period, so only a greater exponent replaces the best one.
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), higher)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = trie.turn_lists(read(spark, sf_dir, "conversations"))
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    rebuilt = trie.with_shared_openings(lists, opening, F.col("conv_id") - F.col("conv_id") % 100, longest=5)
    return trie.trie(trie.turn_paths(rebuilt))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_top_k": op4_top_k,
    "op5_revisits": op5_revisits,
    "op6_quality": op6_quality,
    "op7_token_files": op7_token_files,
    "op8_html_text": op8_html_text,
    "op9_simhash": op9_simhash,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_word_runs": op12_word_runs,
    "op13_conversation_trie": op13_conversation_trie,
}
