"""Materializations: full refresh, view, merge by key, time-range replace.

Targets are catalog tables (``db.table``), managed in a database whose
location is the shared folder (see :func:`stockroom.session.scratch_database`)
or any catalog the cluster provides. Plain parquet has no MERGE, so:

* **merge by key** stores the table partitioned by a hash bucket of the key
  (hidden column ``_part``) and rewrites *only the buckets the batch
  touches* with a dynamic partition overwrite: the old rows of those buckets
  are read (static partition filter on the touched bucket ids, at most
  ``buckets`` values), the batch's keys are anti-joined away, the batch is
  added. Cost grows with the touched buckets, not with the table.
  It commits per partition through Spark's file commit protocol; a failed job
  leaves the previous partitions in place, and the same batch can be run again.
* **time-range replace** and merges that write only the batch's rows commit in
  one step (:mod:`stockroom.sinks.versions`). Null times never fall in a range,
  so they are not written.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.operators.latest import latest_per_key
from stockroom.operators.quality import Audit, AuditError, contract_violations, observed_audits
from stockroom.session import shared_dir

PART = "_part"
MIN_BUCKETS = 16
#: Compressed bytes a bucket should hold.
BUCKET_BYTES = 1 << 30


class SchemaDriftError(ValueError):
    pass


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table without its hidden partition column."""
    df = spark.table(table)
    return df.drop(PART) if PART in df.columns else df


def _visible(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != PART])


def assert_same_schema(target: T.StructType, batch: T.StructType) -> None:
    """Schema-change policy *fail*: names and types must match (order free)."""
    errs = contract_violations(_visible(batch), _visible(target))
    if errs:
        raise SchemaDriftError("schema change on incremental target: " + "; ".join(errs))


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_comments(spark: SparkSession, table: str, comment: str | None = None,
                  columns: Mapping[str, str] | None = None) -> None:
    """Persist a table comment and column comments in the catalog."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {_sql_str(comment)}")
    for c, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{c}` COMMENT {_sql_str(text)}")


def _take_name(spark: SparkSession, new: str, table: str, partitioned: bool) -> None:
    """Drop ``table`` and give its name to ``new``. A rename moves the files of a
    managed table, but a catalog may keep the old folders of its partitions, so
    the partitions are registered again."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def _location(spark: SparkSession, table: str) -> str:
    return next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location")


_PROP_BEFORE = "stockroom.location.before"


def _point_to(spark: SparkSession, table: str, path: str) -> None:
    """One catalog statement gives ``table`` the files of ``path``. The files
    before stay until the next refresh, for queries that are still reading them;
    those before that go now."""
    old, gone = _location(spark, table), _properties(spark, table).get(_PROP_BEFORE)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_sql_str(path)}")
    spark.catalog.refreshTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_sql_str(_PROP_BEFORE)} = {_sql_str(old)})")
    if gone:
        _unstage(spark, gone)


def _same_layout(spark: SparkSession, table: str, df: DataFrame, partition_by: Sequence[str]) -> bool:
    """Whether new files can stand in for the table's: an unpartitioned table
    with the same columns."""
    have = [(f.name, f.dataType) for f in spark.table(table).schema]
    kinds = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return (not partition_by and "# Partition Information" not in kinds and kinds.get("Type") != "VIEW"
            and have == [(f.name, f.dataType) for f in df.schema])


def write_full(df: DataFrame, table: str, partition_by: Sequence[str] = (),
               comment: str | None = None, cluster_by: Sequence[str] = (),
               column_comments: Mapping[str, str] | None = None, audits: Sequence[Audit] = (),
               on_violation: str = "error") -> dict[str, int]:
    """Full refresh: recompute and replace the table (comments are written to
    the catalog with it).

    ``cluster_by``: range-partition and sort the rows by these columns before
    writing (files hold disjoint, sorted key ranges, so min/max statistics
    prune reads); the global order of an ordered model is kept this way
    without a single sorted partition.
    ``audits``: counted while the rows are written and returned; with
    ``on_violation="error"`` rows that violate one are never shown: the table
    stays as it was and :class:`AuditError` is raised (``"warn"`` only counts).

    The rows are written beside the table. An unpartitioned table with the same
    columns then takes them in one catalog statement, so readers find the old
    rows or the new ones. Otherwise (other columns, partitions) the old table is
    dropped and the new one renamed, two statements; a table that must change
    its columns in one step is a versioned one.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    spark = df.sparkSession
    exists = table_exists(spark, table)
    swap = exists and _same_layout(spark, table, df, partition_by)
    watched, violations = observed_audits(df, audits)
    aside = f"{table}__next_{uuid.uuid4().hex[:12]}"
    path = f"{_location(spark, table).rsplit('/', 1)[0]}/{aside.rsplit('.', 1)[-1]}" if swap else None
    try:
        if swap:
            watched.write.parquet(path)
        else:
            # The empty table first: metrics of a CREATE ... AS SELECT are not observed.
            spark.createDataFrame([], df.schema).write.format("parquet").partitionBy(*partition_by).saveAsTable(aside)
            watched.select(*spark.table(aside).columns).write.insertInto(aside)
        found = violations()
        bad = {k: n for k, n in found.items() if n}
        if bad and on_violation == "error":
            raise AuditError("; ".join(f"{k}: {n}" for k, n in bad.items()))
    except Exception:
        _unstage(spark, path) if swap else spark.sql(f"DROP TABLE IF EXISTS {aside}")
        raise
    if swap:
        _point_to(spark, table, path)
    else:
        _take_name(spark, aside, table, bool(partition_by))
    if comment is not None or column_comments:
        with_comments(spark, table, comment, column_comments)
    return found


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: nothing is computed until the view is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_view(spark: SparkSession, name: str, table: str, columns: Sequence[str] = ()) -> None:
    """Persistent catalog view over a table (all columns by default); it is
    replaced if it exists and outlives the session."""
    cols = ", ".join(f"`{c}`" for c in columns) or "*"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {cols} FROM {table}")


_MODE_KEY = "spark.sql.sources.partitionOverwriteMode"


def observed_max(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also yields the maximum of each column, as text."""
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[F.max(c).cast("string").alias(c) for c in cols]), obs


def _stage(df: DataFrame, table: str, kind: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a staging folder of this run in the shared folder and
    read it back: the lineage is cut there, a failed table write is retried
    from it, and two writers of one target do not meet. The caller drops it
    after its commit (see :func:`_unstage`)."""
    path = f"{shared_dir(df.sparkSession)}/stockroom/stage/{table}/{kind}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _unstage(spark: SparkSession, *paths: str) -> None:
    """Delete staging folders through Spark's own file system layer."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def _bytes_of(spark: SparkSession, path: str) -> int:
    """Size of a written folder, from the file system's metadata."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.getContentSummary(p).getLength()


def _insert_dynamic(spark: SparkSession, staged_path: str, schema: T.StructType, table: str,
                    columns: Sequence[str]) -> None:
    """Overwrite only the partitions present in the staged rows.

    ``insertInto`` takes the overwrite mode from the session, so the write
    runs in a child session (same catalog and context, own settings) whose
    mode is dynamic: the caller's session settings are never changed, and
    concurrent writers in that session are unaffected.
    """
    child = spark.newSession()
    child.conf.set(_MODE_KEY, "dynamic")
    (child.read.schema(schema).parquet(staged_path).select(*columns)
          .write.mode("overwrite").insertInto(table))
    spark.catalog.refreshTable(table)   # the caller's session caches file listings


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _check_keys(batch: DataFrame, keys: Sequence[str]) -> None:
    """One aggregation: reject null keys (they never match) and keys repeated
    within the batch (the result would depend on row order)."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = (batch.groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("n"))
                .where((F.col("n") > 1) | any_null)
                .limit(1).collect())
    if bad:
        raise ValueError(f"merge batch has a null or repeated key {list(keys)}: {bad[0].asDict()}")


_PROP_BUCKETS = "stockroom.merge.buckets"
_PROP_KEYS = "stockroom.merge.keys"


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


_PROP_MARK = "stockroom.mark."


def committed_mark(spark: SparkSession, table: str, col: str) -> str | None:
    """High-water mark (ISO text) stored by the last complete run."""
    return _properties(spark, table).get(_PROP_MARK + col)


def commit_mark(spark: SparkSession, table: str, col: str, mark) -> None:
    """Store a run's mark, after its last partition is written."""
    if mark is not None:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PROP_MARK}{col}' = '{mark.isoformat()}')")


def _create_bucketed(spark: SparkSession, table: str, rows: DataFrame, props: Mapping[str, str]) -> None:
    """One statement creates the table with its bucket properties."""
    view = f"__stockroom_stage_{uuid.uuid4().hex[:12]}"
    _by_part(rows).createOrReplaceTempView(view)
    listed = ", ".join(f"{_sql_str(k)} = {_sql_str(v)}" for k, v in props.items())
    try:
        spark.sql(f"CREATE TABLE {table} USING parquet PARTITIONED BY ({PART}) "
                  f"TBLPROPERTIES ({listed}) AS SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def rebucket(spark: SparkSession, table: str, buckets: int) -> None:
    """Rewrite a merge target with another number of buckets (marks and keys
    are kept). Written beside the old table, which keeps its rows until the end."""
    props = {k: v for k, v in _properties(spark, table).items() if k.startswith("stockroom.")}
    if _PROP_BUCKETS not in props:
        raise ValueError(f"{table} was not created by merge_by_key")
    rows = read_table(spark, table).withColumn(PART, bucket_of(props[_PROP_KEYS].split(","), buckets))
    name = f"{table}__next_{uuid.uuid4().hex[:12]}"
    _create_bucketed(spark, name, rows, props | {_PROP_BUCKETS: str(buckets)})
    _take_name(spark, name, table, True)


_PROP_RANGES = "stockroom.ranges"


def processed_days(spark: SparkSession, table: str) -> list[tuple[_dt.date, _dt.date]]:
    """Day ranges that :func:`replace_time_range` has completed, days that hold
    no rows included (the day partitions alone cannot tell those)."""
    text = _properties(spark, table).get(_PROP_RANGES, "") if table_exists(spark, table) else ""
    day = _dt.date.fromisoformat
    return [(day(a), day(b)) for a, b in (r.split("..") for r in text.split(",") if r)]


def missing_days(spark: SparkSession, table: str, start, end) -> list[_dt.date]:
    """Days of ``start .. end`` not yet processed, rising: what to run next."""
    done = processed_days(spark, table)
    lo, hi = (_dt.date.fromisoformat(str(x)[:10]) for x in (start, end))
    days = (lo + _dt.timedelta(days=i) for i in range((hi - lo).days + 1))
    return [d for d in days if not any(a <= d <= b for a, b in done)]


def covered_days(text: str, start, end) -> str:
    """The day ranges of ``text`` and ``start .. end``; ranges that touch merge."""
    day = _dt.date.fromisoformat
    ranges = [tuple(map(day, r.split(".."))) for r in text.split(",") if r]
    merged: list[tuple[_dt.date, _dt.date]] = []
    for a, b in sorted([*ranges, (day(str(start)[:10]), day(str(end)[:10]))]):
        if merged and a <= merged[-1][1] + _dt.timedelta(days=1):
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return ",".join(f"{a}..{b}" for a, b in merged)


def merge_by_key(spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str],
                 buckets: int | None = None, order: Sequence | None = None,
                 check: bool = True, observe: str | None = None):
    """Upsert ``batch`` into ``table`` on ``keys``: matched rows replaced,
    new keys inserted, nothing deleted.

    ``order`` (e.g. ``["event_timestamp"]``): keep whichever of the target
    and the batch row is later under this order instead of letting the batch
    win unconditionally (a recency guard for late or replayed data).
    ``check``: reject null keys (they never match) and keys repeated within
    the batch (the result would depend on row order).
    ``buckets``: hash buckets of a new target (default: about one per GB of
    the first batch, 16 at least). The count and the keys are stored as table
    properties at creation and every later merge uses the stored count, so
    bucket ids always agree; :func:`rebucket` changes it when a table has
    outgrown its buckets.
    ``observe``: a date or time column whose maximum over the batch is returned
    (``None`` if there is none); it is observed while the batch is staged.
    """
    keys = list(keys)
    exists = table_exists(spark, table)
    if exists:
        props = _properties(spark, table)
        if _PROP_BUCKETS not in props:
            raise ValueError(f"{table} was not created by merge_by_key")
        if props.get(_PROP_KEYS) != ",".join(keys):
            raise ValueError(f"{table} is keyed on {props.get(_PROP_KEYS)}, not {keys}")
        buckets = int(props[_PROP_BUCKETS])
    # The batch is computed once (parsing, dedup...) and staged in the shared
    # folder; checks and merge read that copy.
    watched, obs = observed_max(batch, [observe] if observe else [])
    staged, batch_path = _stage(watched, table, "batch")
    newest = obs.get[observe] if observe else None
    if newest is not None:
        parse = _dt.date if isinstance(batch.schema[observe].dataType, T.DateType) else _dt.datetime
        newest = parse.fromisoformat(newest)
    buckets = buckets or max(MIN_BUCKETS, -(-_bytes_of(spark, batch_path) // BUCKET_BYTES))
    staged = staged.withColumn(PART, bucket_of(keys, buckets))
    if check:
        _check_keys(staged, keys)
    if not exists:
        _create_bucketed(spark, table, staged, {_PROP_BUCKETS: str(buckets), _PROP_KEYS: ",".join(keys)})
        _unstage(spark, batch_path)
        return newest
    target = spark.table(table)
    assert_same_schema(target.schema, staged.schema)
    # At most ``buckets`` small ints: a static partition filter, so only the
    # touched bucket directories of the target are listed and read.
    touched = [r[0] for r in staged.select(PART).distinct().collect()]
    old = target.where(F.col(PART).isin(touched))
    if order is None:
        kept = old.join(staged.select(*keys, PART), [*keys, PART], "left_anti")
        new = kept.unionByName(staged)
    else:
        new = latest_per_key(old.unionByName(staged), [*keys], order)
    # The new content of the touched buckets is staged in the shared folder
    # first: Spark does not overwrite a table the same plan reads, and a
    # failure while replacing the buckets can be retried from the staged copy.
    # Grouped by bucket first (keys are unique, so buckets are balanced by the
    # hash): each bucket is then written as one file, not one per task.
    merged, path = _stage(_by_part(new), table, "merge")
    _insert_dynamic(spark, path, merged.schema, table, target.columns)
    _unstage(spark, batch_path, path)
    return newest


def _by_part(df: DataFrame) -> DataFrame:
    """Rows of a partition together before a partitioned write; a rebalance, so
    that large partitions are split and small ones share a task by their size."""
    return df.hint("rebalance", PART)


def replace_time_range(spark: SparkSession, table: str, batch: DataFrame, time_col: str,
                       start, end, unit: str = "timestamp") -> None:
    """Replace exactly the interval ``start .. end`` (whole days; finer bounds
    are refused, see :func:`stockroom.operators.filters.interval_predicate`) of
    ``table`` by ``batch``; rows of the batch outside the interval are not
    written. One commit: readers find the range's old rows or its new ones (see
    :mod:`stockroom.sinks.versions`)."""
    from stockroom.sinks.versions import replace_range
    replace_range(spark, table, batch, time_col, start, end, unit)


def incremental_or_full(spark: SparkSession, table: str,
                        build: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """First-run switch: ``build(None)`` when the target does not exist yet,
    ``build(current_target)`` otherwise (the caller adds its incremental
    filter only in the second case)."""
    return build(read_table(spark, table) if table_exists(spark, table) else None)
