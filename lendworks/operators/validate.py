"""Single-pass validation: flag, split, and report rejected records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendworks.operators.rules import DUPLICATE_FLAG, Rule, reference_flag
from lendworks.operators.skew import flag_duplicates, lookup_join, missing_rows
from lendworks.operators.standardize import standardize
from lendworks.sources.registry import BRONZE_AUDIT, PARENT_PREFIX, SourceSpec

ACCEPTED = "accepted"
BROKEN_RULES = "broken_rules"

REJECT_COLUMNS = (
    "source_table",
    "record_id",
    "rule_code",
    "rejection_reason",
    "rejected_timestamp",
    "raw_record_json",
)


def latest_order(spec: SourceSpec) -> list[Column]:
    """Total order among copies of a key: newest ingestion first, then declared business order.

    Rows that tie on all of it are identical, so which of them survives does not matter.
    """
    named = [("ingestion_timestamp", "desc"), ("source_file_name", "desc"), *spec.latest_by]
    used = {c for c, _ in named}
    named += [(c, "asc") for c in spec.columns if c not in used and c != spec.key]
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_first() for c, d in named]


def with_duplicate_flag(df: DataFrame, spec: SourceSpec, hot: Iterable = ()) -> DataFrame:
    return flag_duplicates(df, spec.key, latest_order(spec), DUPLICATE_FLAG, hot)


def dedupe_latest(df: DataFrame, spec: SourceSpec, hot: Iterable = ()) -> DataFrame:
    """The surviving copy of each key.

    Only the first row is asked for, so each task keeps one row a key before the shuffle: a heavy key crosses it as
    a row a task, listed in ``hot`` or not.
    """
    rank = F.row_number().over(Window.partitionBy(spec.key).orderBy(*latest_order(spec)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def with_reference_flag(
    df: DataFrame, column: str, parent_keys: DataFrame, hot: Iterable = ()
) -> DataFrame:
    """Add a flag telling whether ``column`` occurs in ``parent_keys``.

    The first column of ``parent_keys`` is the unique key; any others come along, prefixed.
    """
    flag = reference_flag(column)
    key, *extra = parent_keys.columns
    known = parent_keys.select(
        F.col(key).alias(column),
        F.lit(True).alias(flag),
        *(F.col(c).alias(PARENT_PREFIX + c) for c in extra),
    )
    looked_up = lookup_join(df, known, column, hot)
    return looked_up.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def orphans(df: DataFrame, column: str, parent_keys: DataFrame, hot: Iterable = ()) -> DataFrame:
    """Rows whose reference is missing from the parent; a NULL reference is an orphan."""
    return missing_rows(df, parent_keys, column, hot)


def _joined_codes(rules: Iterable[Rule], null_policy: str) -> Column:
    """Codes of the broken rules as text, empty for a clean record.

    Text keeps the per-record work in generated code; filtering an array of codes would not.
    """
    return F.concat_ws(",", *(F.when(r.violated(null_policy), F.lit(r.code)) for r in rules))


def _split_codes(column: str) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.col(column) == "", none).otherwise(F.split(column, ","))


def validate(
    bronze: DataFrame,
    spec: SourceSpec,
    parents: Mapping[str, DataFrame] | None = None,
    hot: Mapping[str, Iterable] | None = None,
    null_policy: str = "reject",
    as_at: Column | None = None,
    find_duplicates: bool = True,
) -> DataFrame:
    """Standardise a Bronze table and judge every record against every rule.

    ``parents`` maps each reference column to the accepted keys of its parent source, followed by
    the parent columns the source carries. The result
    holds the cleansed columns, the Bronze audit columns, the codes of all broken rules and the
    ``accepted`` verdict, so accepted and rejected records come from one evaluation.
    ``find_duplicates=False`` leaves the uniqueness rule to ``mark_superseded``.
    """
    hot = hot or {}
    df = standardize(bronze, spec)
    kept = [
        *df.columns,
        *(PARENT_PREFIX + c for columns in spec.carried.values() for c in columns),
    ]
    # References first: they are looked up on the scan, where setting listed keys apart costs no shuffle.
    for column in spec.references:
        df = with_reference_flag(df, column, parents[column], hot.get(column, ()))
    if not (spec.deduplicated and find_duplicates):
        df = df.withColumn(DUPLICATE_FLAG, F.lit(False))
    else:
        df = with_duplicate_flag(df, spec, hot.get(spec.key, ()))

    judged = df.select(
        *kept,
        (F.current_timestamp() if as_at is None else as_at).alias("silver_processed_timestamp"),
        _joined_codes(spec.rules, null_policy).alias("_codes"),
    )
    verdict = F.col("_codes") == ""
    if null_policy == "drop":
        decided = (F.col(r.column).isNotNull() for r in spec.rules if r.kind == "one_of")
        verdict = reduce(lambda a, b: a & b, decided, verdict)
    return judged.select(
        *kept,
        "silver_processed_timestamp",
        _split_codes("_codes").alias(BROKEN_RULES),
        verdict.alias(ACCEPTED),
    )


def mark_superseded(validated: DataFrame, spec: SourceSpec, hot: Iterable = ()) -> DataFrame:
    """Apply the uniqueness rule to records that were validated without it, such as separate loads."""
    code = next(r.code for r in spec.rules if r.kind == "unique")
    superseded = F.col(DUPLICATE_FLAG)
    codes = F.when(superseded, F.array_sort(F.array_union(BROKEN_RULES, F.array(F.lit(code)))))
    return (
        with_duplicate_flag(validated, spec, hot)
        .withColumns(
            {
                BROKEN_RULES: codes.otherwise(F.col(BROKEN_RULES)),
                ACCEPTED: F.col(ACCEPTED) & ~superseded,
            }
        )
        .select(*validated.columns)
    )


def silver_columns(validated: DataFrame) -> list[str]:
    """Columns of the Silver table: all but verdicts and carried parent columns."""
    return [
        c
        for c in validated.columns
        if c not in (BROKEN_RULES, ACCEPTED) and not c.startswith(PARENT_PREFIX)
    ]


def accepted(validated: DataFrame) -> DataFrame:
    """Silver rows: records that broke no rule, marked with their new layer."""
    layer = F.lit("SILVER").alias("pipeline_layer")
    columns = [layer if c == "pipeline_layer" else F.col(c) for c in silver_columns(validated)]
    return validated.filter(F.col(ACCEPTED)).select(*columns)


def broken_rules(df: DataFrame, spec: SourceSpec, *kinds: str, null_policy: str = "reject") -> DataFrame:
    """``(source_table, record_id, rule_code)`` per broken rule of the given kinds.

    ``df`` is standardised and carries whatever flag columns those kinds read.
    """
    chosen = [r for r in spec.rules if r.kind in kinds]
    hits = df.select(
        F.lit(spec.bronze_table).alias("source_table"),
        F.col(spec.key).alias("record_id"),
        _joined_codes(chosen, null_policy).alias("_codes"),
    ).filter(F.col("_codes") != "")
    return hits.select("source_table", "record_id", F.explode(F.split("_codes", ",")).alias("rule_code"))


def rejected(validated: DataFrame, spec: SourceSpec, carry: Iterable[str] = ()) -> DataFrame:
    """One row per record and broken rule, in the envelope shared by all sources; ``carry`` columns come along."""
    reasons = F.create_map(*(F.lit(v) for r in spec.rules for v in (r.code, r.reason)))
    payload = [c for c in (*spec.columns, *BRONZE_AUDIT) if c in validated.columns]
    per_record = validated.filter(~F.col(ACCEPTED)).select(
        F.col(spec.key).cast("string").alias("record_id"),
        F.to_json(F.struct(*payload)).alias("raw_record_json"),
        F.col("silver_processed_timestamp").alias("rejected_timestamp"),
        F.explode(BROKEN_RULES).alias("rule_code"),
        *carry,
    )
    return per_record.select(
        F.lit(spec.bronze_table).alias("source_table"),
        "record_id",
        "rule_code",
        reasons[F.col("rule_code")].alias("rejection_reason"),
        "rejected_timestamp",
        "raw_record_json",
        *carry,
    )


def all_rejects(per_source: Iterable[DataFrame]) -> DataFrame:
    """Rejects of all sources in one table; a source without rejects simply adds no rows."""
    return reduce(lambda a, b: a.unionByName(b), per_source)


def rejects_by_rule(rejects: DataFrame) -> DataFrame:
    return (
        rejects.groupBy("source_table", "rule_code", "rejection_reason")
        .agg(F.count(F.lit(1)).alias("rejected_count"))
        .orderBy("source_table", "rule_code")
    )


def reconcile(validated: DataFrame, spec: SourceSpec) -> DataFrame:
    """Row accounting of one source: every Bronze row is either accepted or rejected."""
    ok = F.col(ACCEPTED)
    reported = ~ok & (F.size(BROKEN_RULES) > 0)
    counts = validated.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(ok).alias("accepted_rows"),
        F.count_if(reported).alias("rejected_rows"),
        F.coalesce(F.sum(F.size(BROKEN_RULES).cast("bigint")), F.lit(0)).alias("reject_records"),
    )
    return counts.select(
        F.lit(spec.name).alias("source"),
        "*",
        (F.col("bronze_rows") == F.col("accepted_rows") + F.col("rejected_rows")).alias("balanced"),
    )
