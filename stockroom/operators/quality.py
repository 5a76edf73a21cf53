"""Data-quality checks: contracts, audits, grain, table diff.

Audits return the *violating rows* (empty = pass), like SQL audits do;
``run_audits`` counts all violations of several audits in one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.casts import wall_to_instant
from stockroom.operators.filters import is_null, not_accepted


class ContractError(ValueError):
    pass


# ---------------------------------------------------------------- contracts

_SIMPLE_TYPES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "binary": T.BinaryType(),
}


def _type_of(t) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return _SIMPLE_TYPES[t.lower()]


def contract_schema(columns: Mapping[str, str | T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, _type_of(t), True) for n, t in columns.items()])


def contract_violations(schema: T.StructType, contract: T.StructType) -> list[str]:
    """Differences by column *name* (order ignored): missing, extra, type."""
    have = {f.name: f.dataType for f in schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    out = [f"missing column {n}" for n in want if n not in have]
    out += [f"unexpected column {n}" for n in have if n not in want]
    out += [f"column {n}: {have[n].simpleString()} != {want[n].simpleString()}"
            for n in want if n in have and have[n] != want[n]]
    return out


def enforce_contract(df: DataFrame, contract: T.StructType | Mapping) -> DataFrame:
    """Check names and exact types (no aliasing of types) before writing;
    raises :class:`ContractError`. No Spark job runs."""
    if not isinstance(contract, T.StructType):
        contract = contract_schema(contract)
    errs = contract_violations(df.schema, contract)
    if errs:
        raise ContractError("; ".join(errs))
    return df


def with_instants(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Every ``timestamp_ntz`` column as TIMESTAMP, read as wall time of
    ``zone`` (for a contract that says TIMESTAMP)."""
    return df.withColumns({c: wall_to_instant(c, zone) for c, t in df.dtypes if t == "timestamp_ntz"})


# ---------------------------------------------------------------- audits

def audit_not_null(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Rows where ``col`` is null, projected to ``keys + [col]``."""
    return df.where(is_null(col)).select(*keys, col)


def audit_accepted_values(df: DataFrame, col: str, values: Iterable,
                          keys: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` is not null and not in ``values``."""
    return df.where(not_accepted(col, values)).select(*keys, col)


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their count (grain check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
              .where(F.col("row_count") > 1))


@dataclass(frozen=True)
class Audit:
    name: str
    kind: str                 # "not_null" | "accepted_values" | "unique"
    column: str | None = None
    values: tuple = ()
    keys: tuple = ()

    def predicate(self) -> Column:
        if self.kind == "not_null":
            return is_null(self.column)
        if self.kind == "accepted_values":
            return not_accepted(self.column, self.values)
        raise ValueError(self.kind)


def run_audits(df: DataFrame, audits: Sequence[Audit]) -> DataFrame:
    """``(audit, violations)`` for every audit in one pass: rows are grouped on
    the first grain with the row-level violations counted per group, and the
    groups are summed. A further, different grain adds a pass of its own."""
    if not audits:
        raise ValueError("no audits given")
    row_level = [(f"c{i}", a) for i, a in enumerate(audits) if a.kind != "unique"]
    grains = {tuple(a.keys): [] for a in audits if a.kind == "unique"}
    for a in audits:
        if a.kind == "unique":
            grains[tuple(a.keys)].append(a)
    parts = []
    for first, keys in enumerate(grains or {(): []}):
        counted = row_level if first == 0 else []
        groups = df.groupBy(*[F.col(k).alias(f"g{i}") for i, k in enumerate(keys)]).agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(a.predicate()).alias(c) for c, a in counted])
        repeated = F.sum(F.when(F.col("n") > 1, F.col("n")))
        cells = [F.struct(F.lit(a.name).alias("audit"), F.coalesce(v, F.lit(0)).alias("violations"))
                 for a, v in [(a, F.sum(c)) for c, a in counted] + [(a, repeated) for a in grains.get(keys, [])]]
        parts.append(groups.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("a"))
                     .select("a.audit", "a.violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("violations", F.col("violations").cast("bigint"))


class AuditError(RuntimeError):
    """Violations of audits that stop a run."""


def observed_audits(df: DataFrame, audits: Sequence[Audit]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` whose next action also counts the violations of ``audits``, and a
    function that returns them, by audit, after that action. The rows are read
    once. A grain is counted by a window over its keys, which needs no exchange
    where the rows lie by these keys already (as after a de-duplication)."""
    cells, cols = [], df.columns
    for i, a in enumerate(audits):
        if a.kind == "unique":
            df = df.withColumn(f"__n{i}", F.count(F.lit(1)).over(Window.partitionBy(*a.keys)))
            cells.append(F.count_if(F.col(f"__n{i}") > 1))
        else:
            cells.append(F.count_if(a.predicate()))
    obs = Observation()
    if not audits:
        return df, dict
    # The counts can be null only if there are no rows.
    watched = df.observe(obs, *[c.alias(f"a{i}") for i, c in enumerate(cells)]).select(*cols)
    return watched, lambda: {a.name: int(obs.get.get(f"a{i}") or 0) for i, a in enumerate(audits)}


#: Audits attached to the typed demo events (fixed values from the model spec).
VEHICLE_AUDITS = (
    Audit("assert_vehicle_condition_not_null", "not_null", "vehicle_condition"),
    Audit("assert_valid_vehicle_types", "accepted_values", "vehicle_type",
          ("USED_CAR", "COMMISSION_CAR")),
    Audit("assert_unique_grain", "unique", keys=("inventory_id", "event_timestamp")),
)


# ---------------------------------------------------------------- table diff

def schema_diff(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Columns added, removed and of another type on the right side."""
    l, r = dict(left.dtypes), dict(right.dtypes)
    return {"added": [c for c in r if c not in l], "removed": [c for c in l if c not in r],
            "changed": [c for c in l if c in r and l[c] != r[c]]}


def table_diff(left: DataFrame, right: DataFrame, keys: Sequence[str],
               columns: Sequence[str] | None = None) -> DataFrame:
    """Row-level diff of two versions of one table on its grain ``keys``:
    one row per key that was ``added`` (right only), ``removed`` (left only)
    or ``changed`` (some compared column differs, nulls compared as values).

    A full outer join on the grain. A key repeated on one side is an error, so
    there is no fan-out. Columns on both sides are compared; columns of one side
    only are a schema change, see :func:`schema_diff`.
    """
    keys = list(keys)
    both = [c for c in left.columns if c in right.columns]
    cols = list(columns or [c for c in both if c not in keys])
    # Renaming the keys of both sides keeps them apart when the sides share
    # their lineage (a table and a changed copy of it).
    l = left.groupBy(*[F.col(k).alias(f"__lk_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("__l"), *[F.first(c).alias(f"__l_{c}") for c in cols])
    r = right.groupBy(*[F.col(k).alias(f"__rk_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("__r"), *[F.first(c).alias(f"__r_{c}") for c in cols])
    cond = [F.col(f"__lk_{k}").eqNullSafe(F.col(f"__rk_{k}")) for k in keys]
    j = l.join(r, cond, "full_outer")
    j = j.withColumn("__once", F.when((F.coalesce("__l", F.lit(1)) == 1) & (F.coalesce("__r", F.lit(1)) == 1), True)
                     .otherwise(F.raise_error(F.lit(f"table_diff: repeated key {keys}"))))
    j = j.where(F.col("__once"))
    key_cols = [F.coalesce(f"__lk_{k}", f"__rk_{k}").alias(k) for k in keys]
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}"))
    change = (F.when(F.col("__l").isNull(), "added")
               .when(F.col("__r").isNull(), "removed")
               .when(~same, "changed"))
    return j.select(*key_cols, change.alias("change")).where(F.col("change").isNotNull())
