"""Tables that change in one step and merges that cost what changed.

A versioned table ``name`` is a catalog view over a data table ``name__data``,
which is partitioned by segment (``_seg``) and part (``_part``). Each commit
writes one new segment, which no reader sees, and then replaces the view: one
catalog statement that makes the new rows visible, hides those they replace and
stores marks, processed days and the like. A reader of ``name``, with this
library or without it, finds the old rows or the new ones, never neither and
never a mix. A run that stops before that statement has changed nothing; what it
left is dropped by the next commit, and so are the parts the last commit hid
(until then :func:`undo` brings them back): just before its own statement, once
its rows are written and checked. One writer at a time.

* :func:`publish`: a full refresh, of any columns and partitions; each commit
  has a table of its own, which is shown only if its audits find nothing.
* :func:`replace_range` (parts are days): the segment holds the range's rows,
  the view hides older segments' days of the range.
* :func:`merge` (parts are hash buckets): the batch becomes a *delta* segment of
  just its rows, whatever buckets the keys lie in. The view takes, for each key
  of a delta, the newest row and leaves all other rows of the base alone: an
  anti join against the deltas' keys, which are broadcast only if the rows and
  bytes counted when they were written are below bounds.
* :func:`compact` rewrites the buckets that deltas touch into a new segment, by
  its own decision or when ``merge`` has left more deltas than a reader should join.

Counts, key bytes and marks come from observed metrics of the write itself; the
table is never read to find them.
"""

from __future__ import annotations

import datetime as _dt
import json
import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.operators.filters import interval_predicate
from stockroom.operators.enrich import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from stockroom.operators.latest import latest_per_key
from stockroom.operators.quality import Audit, AuditError, observed_audits
from stockroom.sinks.tables import (
    MIN_BUCKETS, PART, _by_part, _check_keys, _properties, _sql_str, assert_same_schema, bucket_of,
    covered_days, table_exists,
)

SEG = "_seg"
#: Part of delta segments.
DELTA = -1
#: Deltas a reader joins before ``merge`` compacts them.
MAX_DELTAS = 8
_STATE = "stockroom.version"
_MARK = "stockroom.mark."
_RANGES = "stockroom.ranges"


class NotVersionedError(ValueError):
    pass


def state_of(spark: SparkSession, name: str) -> dict | None:
    """The table's state, ``None`` if there is no such table."""
    if not table_exists(spark, name):
        return None
    props = _properties(spark, name)
    if _STATE not in props:
        raise NotVersionedError(f"{name} is not a versioned table")
    return json.loads(props[_STATE])


def version_of(spark: SparkSession, name: str) -> int:
    """Number of commits that changed the rows (0: no table)."""
    state = state_of(spark, name)
    return state["version"] if state else 0


def previous_version(spark: SparkSession, name: str) -> DataFrame:
    """The rows before the last commit (kept until the next one)."""
    state = state_of(spark, name)
    if state is None or not state.get("previous"):
        raise ValueError(f"{name} has no earlier version")
    return spark.sql(_select(state["previous"]))


def last_delta(spark: SparkSession, name: str) -> DataFrame:
    """The rows of the last merge that is not compacted yet."""
    state = state_of(spark, name)
    seg = state["deltas"][-1]
    return spark.table(state["data"]).where((F.col(PART) == DELTA) & (F.col(SEG) == seg)).select(*state["columns"])


# ---------------------------------------------------------------- what the view shows

def _cols(names: Sequence[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}`{c}`" for c in names)


def _visible(state: Mapping) -> str:
    """Predicate of the rows that are not deltas."""
    out = f"{SEG} <= {state['seg']}"
    if state["kind"] == "key":
        out += f" AND {PART} >= 0"
    hidden = state["hidden"]
    if hidden:
        parts = (" OR ".join(f"{PART} BETWEEN DATE'{lo}' AND DATE'{hi}'" for lo, hi in hidden) if state["kind"] == "range"
                 else f"{PART} IN ({', '.join(map(str, hidden))})")
        out += f" AND NOT ({SEG} < {state['base']} AND ({parts}))"
    return out


def _select(state: Mapping) -> str:
    cols, data = state["columns"], state["data"]
    if state["kind"] == "full":
        return f"SELECT {_cols(cols)} FROM {data}"
    base = f"SELECT {_cols(cols)} FROM {data} WHERE {_visible(state)}"
    if not state.get("deltas"):
        return base
    keys, order = state["keys"], state["order"]
    segs = ", ".join(str(d) for d in state["deltas"])
    hint = "/*+ BROADCAST(k) */ " if state["rows"] <= MAX_BROADCAST_ROWS and state["bytes"] <= MAX_BROADCAST_BYTES else ""
    on = " AND ".join(f"b.`{c}` = k.`{c}`" for c in keys)
    newest = ", ".join([*(f"`{c}` DESC" for c in order), f"{SEG} DESC"])
    # With an order the base row of a key competes; else the delta always wins.
    rivals = (f" UNION ALL SELECT {hint}{_cols(cols, 'b.')}, 0 AS {SEG} FROM base b LEFT SEMI JOIN k ON {on}" if order else "")
    return (f"WITH base AS ({base}), d AS (SELECT {_cols(cols)}, {SEG} FROM {data} WHERE {PART} = {DELTA} AND {SEG} IN ({segs})), "
            f"k AS (SELECT DISTINCT {_cols(keys)} FROM d), "
            f"w AS (SELECT *, row_number() OVER (PARTITION BY {_cols(keys)} ORDER BY {newest}) AS __rn FROM (SELECT * FROM d{rivals})) "
            f"SELECT {hint}{_cols(cols, 'b.')} FROM base b LEFT ANTI JOIN k ON {on} "
            f"UNION ALL SELECT {_cols(cols)} FROM w WHERE __rn = 1")


def _publish(spark: SparkSession, name: str, state: dict, props: Mapping[str, str]) -> None:
    """The commit: one statement replaces the view and its properties."""
    listed = ", ".join(f"{_sql_str(k)} = {_sql_str(v)}" for k, v in {**props, _STATE: json.dumps(state)}.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS {_select(state)}")


# ---------------------------------------------------------------- segments

def _parts(spark: SparkSession, data: str) -> list[tuple[int, str]]:
    """(segment, part) of every partition, from the catalog."""
    out = []
    for (spec,) in spark.sql(f"SHOW PARTITIONS {data}").collect():
        at = dict(x.split("=", 1) for x in spec.split("/"))
        out.append((int(at[SEG]), at[PART]))
    return out


def _drop_parts(spark: SparkSession, state: Mapping, parts: Sequence[tuple[int, str]]) -> None:
    if parts:
        lit = (lambda p: f"DATE'{p}'") if state["kind"] == "range" else str
        listed = ", ".join(f"PARTITION ({SEG} = {s}, {PART} = {lit(p)})" for s, p in parts)
        spark.sql(f"ALTER TABLE {state['data']} DROP IF EXISTS {listed}")


def _is_hidden(state: Mapping, seg: int, part: str) -> bool:
    """Whether the last commit (or none) shows this partition."""
    if seg > state["seg"]:
        return True                           # left by a run that stopped
    if state["kind"] == "key" and int(part) == DELTA:
        return seg not in state["deltas"]
    hidden = state["hidden"]
    if not hidden or seg >= state["base"]:
        return False
    return any(lo <= part <= hi for lo, hi in hidden) if state["kind"] == "range" else int(part) in hidden


def _clean(spark: SparkSession, name: str, state: Mapping, new: int) -> None:
    """Drop what no reader of the current version sees, but for the segment ``new``
    that is about to be shown."""
    if state["kind"] == "full":
        _drop_tables(spark, name, keep=(state["data"], f"{name}__v{new}"))
        return
    _drop_parts(spark, state, [p for p in _parts(spark, state["data"]) if p[0] != new and _is_hidden(state, *p)])


def _drop_tables(spark: SparkSession, name: str, keep: Sequence[str] = ()) -> None:
    """Tables of earlier versions, and of runs that stopped."""
    db, _, short = name.rpartition(".")
    for r in spark.sql(f"SHOW TABLES {f'IN {db} ' if db else ''}LIKE '{short}__v*'").collect():
        t = f"{db}.{r.tableName}" if db else r.tableName
        if not r.isTemporary and t not in keep and r.tableName[len(short) + 3:].isdigit():
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def _next_segment(state: Mapping | None) -> int:
    """A number above all committed ones that no earlier, stopped run has used."""
    return ((state["seg"] >> 20 if state else 0) + 1 << 20) + random.getrandbits(20)


def _write_segment(spark: SparkSession, data: str, rows: DataFrame, seg: int, columns: Sequence[str], first: bool,
                   keys: Sequence[str] = (), marks: Sequence[str] = ()) -> Mapping:
    """Write a segment; rows, key bytes and marks are observed on the way (above
    any exchange, since an empty stage is planned away with what lies below it)."""
    rows = rows.select(*columns, F.lit(seg).cast("bigint").alias(SEG), PART)
    if first:       # whatever a stopped first run left is replaced; no view shows it
        empty = spark.createDataFrame([], rows.schema)
        empty.write.format("parquet").mode("overwrite").partitionBy(SEG, PART).saveAsTable(data)
    size = [F.octet_length(F.col(k).cast("string")) for k in keys]
    obs = Observation()
    (rows.observe(obs, F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(sum(size[1:], size[0]) if size else F.lit(0)), F.lit(0)).cast("bigint").alias("bytes"),
                  *[F.max(c).cast("string").alias(f"mark_{c}") for c in marks])
     .write.insertInto(data))
    spark.catalog.refreshTable(data)
    return obs.get


def _with_marks(props: Mapping[str, str], got: Mapping, marks: Sequence[str]) -> dict[str, str]:
    """The larger of each old mark and the batch's."""
    out = dict(props)
    for c in marks:
        new = got.get(f"mark_{c}")
        if new is not None:
            new = new.replace(" ", "T")
            old = out.get(_MARK + c)
            out[_MARK + c] = new if old is None else max(old, new, key=_dt.datetime.fromisoformat)
    return out


def _kept_properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not table_exists(spark, name):
        return {}
    return {k: v for k, v in _properties(spark, name).items() if k.startswith("stockroom.") and k != _STATE}


def _following(spark: SparkSession, name: str, state: Mapping | None, **changes) -> dict:
    """The next state; the one before it, with its properties, is kept for :func:`undo`."""
    before = {k: v for k, v in state.items() if k != "previous"} if state else {}
    previous = before | {"properties": _kept_properties(spark, name)} if state else None
    return before | changes | {"previous": previous}


def _check_target(spark: SparkSession, name: str, state: Mapping | None, kind: str, batch: T.StructType) -> None:
    if state is not None:
        if state["kind"] != kind:
            raise NotVersionedError(f"{name} is a table of kind {state['kind']}, not {kind}")
        assert_same_schema(spark.table(name).schema, batch)


def _data_table(name: str) -> str:
    return f"{name}__data"


# ---------------------------------------------------------------- commits

def publish(spark: SparkSession, name: str, df: DataFrame, partition_by: Sequence[str] = (), audits: Sequence[Audit] = (),
            on_violation: str = "error", properties: Mapping[str, str] | None = None) -> dict[str, int]:
    """Full refresh in one step, also when columns or partitions change. Audits
    are counted while the rows are written and returned; with
    ``on_violation="error"`` rows that violate one are never shown."""
    state = state_of(spark, name)
    if state is not None and state["kind"] != "full":
        raise NotVersionedError(f"{name} is a table of kind {state['kind']}, not full")
    if state is None:
        _drop_tables(spark, name)
    seg = _next_segment(state)
    table = f"{name}__v{seg}"
    watched, violations = observed_audits(df, audits)
    try:
        spark.createDataFrame([], df.schema).write.format("parquet").partitionBy(*partition_by).saveAsTable(table)
        watched.select(*spark.table(table).columns).write.insertInto(table)
        found = violations()
        bad = {k: n for k, n in found.items() if n}
        if bad and on_violation == "error":
            raise AuditError("; ".join(f"{k}: {n}" for k, n in bad.items()))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    if state:
        _clean(spark, name, state, seg)
    _publish(spark, name, _following(spark, name, state, kind="full", data=table, columns=df.columns, seg=seg,
                                     version=(state["version"] if state else 0) + 1),
             _kept_properties(spark, name) | dict(properties or {}))
    return found


def replace_range(spark: SparkSession, name: str, batch: DataFrame, time_col: str, start, end,
                  unit: str = "timestamp", marks: Sequence[str] = (), properties: Mapping[str, str] | None = None) -> None:
    """Replace exactly the days ``start .. end`` of ``name`` by the batch's rows
    in that range, including days that became empty, in one commit, which also
    records the days as processed."""
    wanted = batch.where(interval_predicate(time_col, start, end, unit))
    lo, hi = (_dt.date.fromisoformat(str(x)[:10]).isoformat() for x in (start, end))
    ranges = _kept_properties(spark, name).get(_RANGES, "")
    _replace(spark, name, wanted, time_col, [[lo, hi]], marks,
             {_RANGES: covered_days(ranges, start, end), **(properties or {})})


def replace_days(spark: SparkSession, name: str, batch: DataFrame, day_col: str, days: Sequence[_dt.date],
                 properties: Mapping[str, str] | None = None) -> None:
    """Replace the given days of ``name`` by the batch's rows, which all lie in
    these days, in one commit."""
    runs = [x.split("..") for x in covered_runs(days)]
    _replace(spark, name, batch, day_col, runs, (), properties or {})


def covered_runs(days: Sequence[_dt.date]) -> list[str]:
    out = ""
    for d in sorted(days):
        out = covered_days(out, d, d)
    return out.split(",") if out else []


def _replace(spark, name, rows: DataFrame, time_col: str, hidden: list, marks: Sequence[str], properties: Mapping[str, str]) -> None:
    state = state_of(spark, name)
    _check_target(spark, name, state, "range", rows.schema)
    columns = state["columns"] if state else rows.columns
    seg, data = _next_segment(state), state["data"] if state else _data_table(name)
    got = _write_segment(spark, data, _by_part(rows.withColumn(PART, F.to_date(F.col(time_col)))), seg, columns,
                         state is None, marks=marks)
    if state:
        _clean(spark, name, state, seg)
    props = _with_marks(_kept_properties(spark, name), got, marks) | dict(properties)
    _publish(spark, name, _following(spark, name, state, kind="range", data=data, columns=list(columns), seg=seg, base=seg,
                                     hidden=hidden, version=(state["version"] if state else 0) + 1), props)


def merge(spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
          marks: Sequence[str] = (), check: bool = True, buckets: int | None = None,
          max_deltas: int = MAX_DELTAS, properties: Mapping[str, str] | None = None) -> None:
    """Upsert ``batch`` into ``name`` on ``keys`` by writing its rows as a delta.

    ``order``: columns by which the later of the stored and the new row stays
    (of equal ones the new row); without it the new row always wins. ``marks``:
    columns whose maximum over all batches is stored with the commit. ``check``:
    reject null and repeated keys before the commit. ``buckets``: parts of a new
    table's base. ``max_deltas``: compact when a table has more deltas."""
    keys, order = list(keys), list(order)
    state = state_of(spark, name)
    _check_target(spark, name, state, "key", batch.schema)
    if state and state["keys"] != keys:
        raise ValueError(f"{name} is keyed on {state['keys']}, not {keys}")
    if state and state["deltas"] and state["order"] != order:
        compact(spark, name)                    # deltas of one order only
        state = state_of(spark, name)
    columns = state["columns"] if state else batch.columns
    if state:
        rows = batch.withColumn(PART, F.lit(DELTA))
    else:
        buckets = buckets or MIN_BUCKETS
        rows = _by_part(batch.withColumn(PART, bucket_of(keys, buckets)))
    seg, data = _next_segment(state), state["data"] if state else _data_table(name)
    got = _write_segment(spark, data, rows, seg, columns, state is None, keys, marks)
    if check:
        _check_keys(spark.table(data).where(F.col(SEG) == seg), keys)
    if state:
        _clean(spark, name, state, seg)
    props = _with_marks(_kept_properties(spark, name), got, marks) | dict(properties or {})
    if state is None:
        _publish(spark, name, _following(spark, name, None, kind="key", data=data, columns=list(columns), keys=keys, order=order,
                                         buckets=buckets, seg=seg, base=seg, hidden=[], deltas=[], rows=0, bytes=0,
                                         version=1), props)
        return
    deltas = [*state["deltas"], seg] if got["rows"] else state["deltas"]
    _publish(spark, name, _following(spark, name, state, order=order, seg=seg, deltas=deltas, rows=state["rows"] + got["rows"],
                                     bytes=state["bytes"] + got["bytes"], version=state["version"] + bool(got["rows"])), props)
    if len(deltas) > max_deltas:
        compact(spark, name)


def compact(spark: SparkSession, name: str, buckets: int | None = None) -> None:
    """Rewrite the buckets that deltas touch, so that readers join nothing.
    ``buckets``: deal all rows out to another number of buckets (a table that
    outgrew its own)."""
    state = state_of(spark, name)
    if state is None or state["kind"] != "key":
        raise NotVersionedError(f"{name} is no table with deltas")
    if not state["deltas"] and buckets in (None, state["buckets"]):
        return
    count = buckets or state["buckets"]
    rows = spark.table(name).withColumn(PART, bucket_of(state["keys"], count))
    if count == state["buckets"]:
        deltas = spark.table(state["data"]).where((F.col(PART) == DELTA) & F.col(SEG).isin(state["deltas"]))
        touched = sorted(r[0] for r in deltas.select(bucket_of(state["keys"], count).alias("b")).distinct().collect())
        # Only these buckets' files of the base are read: the view's rows of a
        # bucket all lie in that part, or in a delta.
        base = spark.table(state["data"]).where(_visible(state)).where(F.col(PART).isin(touched)).drop(SEG)
        rows = _merged(base, deltas, state).withColumn(PART, bucket_of(state["keys"], count))
        hidden = touched
    else:
        hidden = list(range(state["buckets"]))
    seg = _next_segment(state)
    _write_segment(spark, state["data"], _by_part(rows), seg, state["columns"], first=False)
    _clean(spark, name, state, seg)
    _publish(spark, name, _following(spark, name, state, seg=seg, base=seg, hidden=hidden, deltas=[], rows=0, bytes=0, buckets=count),
             _kept_properties(spark, name))


def _merged(base: DataFrame, deltas: DataFrame, state: Mapping) -> DataFrame:
    """Newest row of each key of two frames with the table's columns."""
    cols, keys = state["columns"], state["keys"]
    both = base.select(*cols, F.lit(0).cast("bigint").alias(SEG)).unionByName(deltas.select(*cols, SEG))
    return latest_per_key(both, keys, [*state["order"], SEG]).select(*cols)


def note(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    """Store properties with the rows as they are (one step)."""
    _publish(spark, name, state_of(spark, name), _kept_properties(spark, name) | dict(properties))


def undo(spark: SparkSession, name: str) -> None:
    """Take the last commit back, with its marks and other properties (one step)."""
    state = state_of(spark, name)
    if state is None or not state.get("previous"):
        raise ValueError(f"{name} has no earlier version")
    before = dict(state["previous"], previous=None)
    _publish(spark, name, before, before.pop("properties"))


def drop(spark: SparkSession, name: str) -> None:
    state = state_of(spark, name)
    if state:
        spark.sql(f"DROP VIEW {name}")
        if state["kind"] == "full":
            _drop_tables(spark, name)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {state['data']}")
