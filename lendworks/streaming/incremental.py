"""Incremental loads: each raw file is read once, and Silver keeps the latest record per key."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lendworks.config import LakeConfig
from lendworks.operators.skew import heavy_keys
from lendworks.operators.standardize import standardize
from lendworks.operators.validate import ACCEPTED, BROKEN_RULES, mark_superseded, rejected, validate
from lendworks.sources.raw_files import CORRUPT, malformed_lines, stamp_bronze, with_source_file
from lendworks.sources.registry import PARENT_PREFIX, SOURCES, SourceSpec
from lendworks.staging import delete, exists
from lendworks.streaming.buckets import BUCKETS, BucketedTable


def raw_file_stream(
    spark: SparkSession,
    spec: SourceSpec,
    folder: str,
    now: Column | None = None,
    today: Column | None = None,
    batch_id: str | None = None,
    max_files: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Bronze rows of files as they arrive in a source's raw folder.

    ``keep_corrupt`` adds the text of malformed lines as a column, which ``malformed_lines`` reports. It is written
    with the rows, so a replayed batch repeats neither.
    """
    schema = spec.schema.add(CORRUPT, "string") if keep_corrupt else spec.schema
    reader = spark.readStream.schema(schema).options(header=True, mode="PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return stamp_bronze(with_source_file(reader.csv(folder)), spec, now, today, batch_id)


def append_new_files(stream: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that arrived since the last run to Bronze, then stop.

    The checkpoint remembers the files read and the file sink commits each batch once, so a rerun
    or a restart after a failure neither loses nor repeats a file.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def validate_new_rows(
    spark: SparkSession,
    spec: SourceSpec,
    bronze_path: str,
    bronze_schema,
    parent_keys: Callable[[], Mapping[str, DataFrame]],
    log_path: str,
    checkpoint: str,
    null_policy: str = "reject",
    as_at: Column | None = None,
) -> StreamingQuery:
    """Validate Bronze rows appended since the last run into a log of validated batches.

    A batch is judged by every rule except uniqueness, against the parent keys accepted by then, and
    costs only its own size. Each batch owns one folder, so replaying it after a failure replaces
    what it wrote. ``current_records`` settles duplicates across batches.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        verdicts = validate(
            batch,
            spec,
            parent_keys(),
            heavy_keys(standardize(batch, spec), list(spec.references)),
            null_policy,
            as_at=as_at,
            find_duplicates=False,
        )
        verdicts.write.mode("overwrite").partitionBy(ACCEPTED).parquet(f"{log_path}/load={batch_id}")

    query = (
        spark.readStream.schema(bronze_schema)
        .parquet(bronze_path)
        .writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def validated_log(spark: SparkSession, log_path: str) -> DataFrame:
    log = spark.read.parquet(log_path).drop("load")
    return log.withColumn(ACCEPTED, F.col(ACCEPTED).cast("boolean"))  # folder names are text


def current_records(
    log: DataFrame, spec: SourceSpec, hot: Iterable | None = None
) -> DataFrame:
    """All validated records with superseded ones marked as duplicates.

    The newest record of a key decides, valid or not, as in a full refresh over the same rows, given the parents
    they were judged against. Accepted and rejected records are then taken from it as from any validated table.
    """
    if not spec.deduplicated:
        return log
    if hot is None:
        hot = heavy_keys(log, [spec.key])[spec.key]
    return mark_superseded(log, spec, hot)


def rejudge(records: DataFrame, spec: SourceSpec, column: str, changed: DataFrame) -> DataFrame:
    """Judge anew whether ``column`` has its parent, for parents whose acceptance or carried columns changed.

    ``changed`` has one row per such parent: its key, whether it is accepted now (``_known``), and the carried
    columns. A record that was an orphan is accepted once its parent is, if it breaks no other rule.
    """
    code = next(r.code for r in spec.rules if r.kind == "exists" and r.column == column)
    carried = spec.carried.get(column, ())
    found = changed.select(
        F.col(changed.columns[0]).alias("_parent"), "_known", *(F.col(c).alias(f"_new_{c}") for c in carried)
    )
    codes = (
        F.when(F.col("_known").isNull(), F.col(BROKEN_RULES))
        .when(F.col("_known"), F.array_remove(BROKEN_RULES, code))
        .otherwise(F.array_sort(F.array_union(BROKEN_RULES, F.array(F.lit(code)))))
    )
    updates = {BROKEN_RULES: codes}
    for c in carried:
        now = F.when(F.col("_known").isNull(), F.col(PARENT_PREFIX + c)).otherwise(F.col(f"_new_{c}"))
        updates[PARENT_PREFIX + c] = now
    judged = records.join(found, F.col(column) == F.col("_parent"), "left").withColumns(updates)
    judged = judged.withColumn(ACCEPTED, F.size(BROKEN_RULES) == 0)
    return judged.select(*records.columns)


def acceptance_changes(before: DataFrame, after: DataFrame, spec: SourceSpec, columns: Iterable[str]) -> DataFrame:
    """Keys whose acceptance or passed-on columns differ between two versions of the same buckets, by one join.

    A row per key: whether it is accepted now (``_known``), and the columns as they are now.
    """
    columns = list(columns)

    def keys(records: DataFrame, prefix: str) -> DataFrame:
        kept = (F.col(c).alias(f"{prefix}{c}") for c in columns)
        return records.filter(ACCEPTED).select(spec.key, F.lit(True).alias(f"{prefix}known"), *kept)

    both = keys(after, "_now_").join(keys(before, "_was_"), spec.key, "full_outer")
    same = F.col("_now_known").eqNullSafe(F.col("_was_known"))
    for c in columns:
        same &= F.col(f"_now_{c}").eqNullSafe(F.col(f"_was_{c}"))
    known = F.col("_now_known").isNotNull().alias("_known")
    return both.filter(~same).select(spec.key, known, *(F.col(f"_now_{c}").alias(c) for c in columns))


LEDGER = "version bigint, read_rows bigint, accepted_rows bigint, rejected_rows bigint, superseded_rows bigint"


class IncrementalSilver:
    """Silver kept up to date load by load, ending where a full refresh over the same files does.

    Parents are loaded before children. Every load appends the new files to Bronze and judges only their rows. The
    records lie in hash buckets of their key: the next version reads and rewrites the buckets of the keys that
    arrived, and of the records whose parent came late, changed or was withdrawn; all other files stay as they are.
    (To find the latter, one column is scanned and compared with the changed parents.) A version is complete once
    written and never changed, so a failed load is simply run again from the last one. With each version go the
    rejects of its buckets and a line of the row ledger, which a repeated load replaces. NULLs in domain columns are
    rejected, as by default elsewhere.
    """

    def __init__(self, spark: SparkSession, cfg: LakeConfig, buckets: int = BUCKETS):
        self.spark, self.cfg = spark, cfg
        self.tables = {
            s: BucketedTable(
                spark, self._path("versions", s), self._record_schema(spec), spec.key, buckets, partition_by=(ACCEPTED,)
            )
            for s, spec in SOURCES.items()
        }

    def _path(self, kind: str, source: str) -> str:
        return self.cfg.zone("incremental", f"{kind}/{source}")

    def _bronze_schema(self, spec: SourceSpec) -> StructType:
        raw = self.spark.createDataFrame([], spec.schema.add("source_file_name", "string"))
        return stamp_bronze(raw, spec, self.cfg.now(), self.cfg.today(), self.cfg.batch_id).schema

    def _record_schema(self, spec: SourceSpec) -> StructType:
        empty = self.spark.createDataFrame([], self._bronze_schema(spec))
        parents = {
            c: self.spark.createDataFrame([], ", ".join(f"{x} string" for x in (SOURCES[p].key, *spec.carried.get(c, ()))))
            for c, p in spec.references.items()
        }
        return validate(empty, spec, parents, as_at=self.cfg.now()).schema

    def _listed(self, folder: str, prefix: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(prefix)]
        done = "_SUCCESS"
        return sorted(p.getName() for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, done)))

    def _last(self, source: str) -> tuple[int, int]:
        """Number of the last version, and how many loads it holds."""
        number, loads = self.tables[source].last()
        return number, int(loads or 0)

    def records(self, source: str) -> DataFrame | None:
        """All validated records of the last version, superseded ones marked; None before any load."""
        table = self.tables[source]
        return table.read() if table.last()[0] else None

    def rejects(self) -> DataFrame:
        """The rejected zone: the rejects of every bucket's current version, read from their files."""
        envelope = rejected(self.spark.createDataFrame([], self._record_schema(SOURCES["delinquency"])), SOURCES["delinquency"])
        found = [self.spark.createDataFrame([], envelope.schema)]
        for source, table in self.tables.items():
            base = self._path("rejected", source)
            names = {n: name for n in table.versions() for name in [f"version={n:06d}"]}
            held = {n: set(table._names(f"{base}/{name}", "bucket=")) for n, name in names.items()}
            paths = [f"{base}/{names[n]}/bucket={b}" for b, n in table.layout().items() if f"bucket={b}" in held[n]]
            if paths:
                stored = self.spark.read.schema(envelope.schema).option("basePath", base).parquet(*paths)
                found.append(stored.select(*envelope.columns))
        return reduce(lambda a, b: a.unionByName(b), found)

    def malformed(self) -> DataFrame:
        """Lines that did not fit their schema: ``source, source_file_name, record_id, line``, as a refresh reports them."""
        found = [self.spark.createDataFrame([], "source string, source_file_name string, record_id string, line string")]
        for source, spec in SOURCES.items():
            if exists(self.spark, self._path("bronze", source)):
                schema = self._bronze_schema(spec).add(CORRUPT, "string")
                found.append(malformed_lines(self.spark.read.schema(schema).parquet(self._path("bronze", source)), spec))
        return reduce(lambda a, b: a.unionByName(b), found)

    def ledger(self) -> DataFrame:
        """What every version of a source read and how it moved the rows: ``source`` and the columns of LEDGER."""
        found = [self.spark.createDataFrame([], f"source string, {LEDGER}")]
        for source in SOURCES:
            folder = self._path("ledger", source)
            if exists(self.spark, folder):
                lines = self.spark.read.schema(LEDGER).parquet(f"{folder}/version=*")
                found.append(lines.select(F.lit(source).alias("source"), "*"))
        return reduce(lambda a, b: a.unionByName(b), found)

    def balance(self) -> DataFrame:
        """Per source the ledger's sums: every row that was read is accepted or rejected now."""
        sums = self.ledger().groupBy("source").agg(
            *(F.sum(c).alias(c) for c in ("read_rows", "accepted_rows", "rejected_rows", "superseded_rows"))
        )
        return sums.withColumn("balanced", F.col("read_rows") == F.col("accepted_rows") + F.col("rejected_rows"))

    def _accepted_keys(self, source: str, records: DataFrame | None, columns: Iterable[str]) -> DataFrame:
        spec = SOURCES[source]
        if records is None:
            kinds = ", ".join(f"{c} string" for c in (spec.key, *columns))
            return self.spark.createDataFrame([], kinds)
        return records.filter(ACCEPTED).select(spec.key, *columns)

    def _passed_on(self, source: str) -> list[str]:
        """Columns that children carry from this source."""
        carried = [
            c for s in SOURCES.values() for ref, parent in s.references.items() if parent == source for c in s.carried.get(ref, ())
        ]
        return list(dict.fromkeys(carried))

    def load(self) -> dict[str, DataFrame]:
        """Take in everything that arrived since the last load; returns the records of every source so far."""
        changes: dict[str, DataFrame] = {}
        for source, spec in SOURCES.items():
            if exists(self.spark, self.cfg.raw(source)):
                stream = raw_file_stream(
                    self.spark,
                    spec,
                    self.cfg.raw(source),
                    self.cfg.now(),
                    self.cfg.today(),
                    self.cfg.batch_id,
                    keep_corrupt=True,
                )
                append_new_files(stream, self._path("bronze", source), self.cfg.checkpoint(f"bronze/{source}"))
                validate_new_rows(
                    self.spark,
                    spec,
                    self._path("bronze", source),
                    self._bronze_schema(spec),
                    lambda spec=spec: {
                        c: self._accepted_keys(p, self.records(p), spec.carried.get(c, ())) for c, p in spec.references.items()
                    },
                    self._path("log", source),
                    self.cfg.checkpoint(f"silver/{source}"),
                    as_at=self.cfg.now(),
                )
            self._next_version(spec, changes)
        return {s: r for s in SOURCES if (r := self.records(s)) is not None}

    def _new_records(self, spec: SourceSpec, names: list[str]) -> DataFrame:
        schema, log = self.tables[spec.name].schema, self._path("log", spec.name)
        frames = [self.spark.read.schema(schema).parquet(f"{log}/{name}").select(*schema.fieldNames()) for name in names]
        return reduce(lambda a, b: a.unionByName(b), frames, self.spark.createDataFrame([], schema))

    def _next_version(self, spec: SourceSpec, changes: dict[str, DataFrame]) -> None:
        table = self.tables[spec.name]
        number, folded = self._last(spec.name)
        loads = sorted(self._listed(self._path("log", spec.name), "load="), key=lambda n: int(n.removeprefix("load=")))
        new = self._new_records(spec, loads[folded:])
        affected = {c: changes[p] for c, p in spec.references.items() if p in changes}
        touched = table.buckets_of(new) if loads[folded:] else set()
        if number:
            for column, changed in affected.items():
                parent = changed.select(F.col(changed.columns[0]).alias(column))
                children = table.read().select(*{spec.key: 0, column: 0})
                touched |= table.buckets_of(children.join(parent, column, "left_semi"))
        if not touched:
            return

        before = table.read(touched, number)
        after = before
        for column, changed in affected.items():
            after = rejudge(after, spec, column, changed)
        after = current_records(after.unionByName(new), spec)
        self._write_version(spec, number + 1, len(loads), before, new, after)
        now = table.read(touched, number + 1)
        changes[spec.name] = acceptance_changes(before, now, spec, self._passed_on(spec.name))

    def _write_version(
        self, spec: SourceSpec, number: int, loads: int, before: DataFrame, new: DataFrame, after: DataFrame
    ) -> None:
        """Rejects, ledger and records of a version. The records come last: only they make it count."""
        table = self.tables[spec.name]
        # Judged and settled once: rejects and ledger are read from what was written.
        draft = f"{self._path('draft', spec.name)}/version={number:06d}"
        seen = Observation()
        counts = row_counts_of(spec)
        after.observe(seen, *counts).write.mode("overwrite").parquet(draft)
        settled = self.spark.read.schema(table.schema).parquet(draft)
        was = before.agg(*counts).first().asDict()
        now = seen.get
        line = [number, new.count(), *((now.get(c) or 0) - was[c] for c in ("accepted_rows", "rejected_rows", "superseded_rows"))]
        folder = f"{self._path('ledger', spec.name)}/version={number:06d}"
        self.spark.createDataFrame([tuple(line)], LEDGER).coalesce(1).write.mode("overwrite").parquet(folder)
        turned_away = settled.withColumn("bucket", table.bucket()).filter(~F.col(ACCEPTED))
        zone = f"{self._path('rejected', spec.name)}/version={number:06d}"
        envelope = rejected(turned_away, spec, carry=("bucket",)).hint("rebalance", "bucket", "rule_code")
        envelope.write.mode("overwrite").partitionBy("bucket", "rule_code").parquet(zone)
        table.write(settled, number, f"{loads:06d}")
        delete(self.spark, draft)

    def expire(self, keep: int = 2, needed: Mapping[str, Iterable[int]] | None = None) -> dict[str, list[str]]:
        """Delete what only versions older than the last ``keep``, and not ``needed`` ones, still show."""
        return {s: t.expire(keep, (needed or {}).get(s, ())) for s, t in self.tables.items()}


def row_counts_of(spec: SourceSpec) -> list[Column]:
    """How many records are accepted, rejected, and rejected because a newer one of their key came."""
    code = next((r.code for r in spec.rules if r.kind == "unique"), None)
    superseded = F.array_contains(BROKEN_RULES, code) if code else F.lit(False)
    return [
        F.count_if(F.col(ACCEPTED)).alias("accepted_rows"),
        F.count_if(~F.col(ACCEPTED)).alias("rejected_rows"),
        F.count_if(superseded).alias("superseded_rows"),
    ]
