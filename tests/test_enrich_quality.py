import datetime as dt

import pytest

from stockroom.operators import (
    Audit, ContractError, DuplicateKeyError, audit_accepted_values, audit_not_null, audit_unique,
    contract_schema, enforce_contract, left_join_dimension, run_audits, table_diff,
)
from tests.conftest import rows


def test_left_join_dimension_nulls_and_fanout(spark):
    facts = spark.createDataFrame([(1, "DE"), (2, "FR"), (3, None)], "id int, country string")
    dim = spark.createDataFrame([("DE", "EU"), ("DE", "EU2"), ("IT", "EU")], "country string, region string")
    out = left_join_dimension(facts, dim, "country")
    assert rows(out.select("id", "region")) == [(1, "EU"), (1, "EU2"), (2, None), (3, None)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(DuplicateKeyError):
        left_join_dimension(facts, dim, "country", unique=True)


def test_large_dimension_is_not_force_broadcast(spark):
    facts = spark.range(10).withColumnRenamed("id", "k")
    dim = spark.range(100).withColumnRenamed("id", "k")
    out = left_join_dimension(facts, dim, "k", max_broadcast_rows=10)
    assert out.count() == 10   # joined by shuffle (or by AQE from real sizes)
    out = left_join_dimension(facts, dim, "k", max_broadcast_bytes=100)
    assert out.count() == 10
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def test_contract_by_name_and_exact_type(spark):
    df = spark.createDataFrame([(1, "a")], "b int, a string")
    enforce_contract(df, contract_schema({"a": "string", "b": "int"}))   # order free
    with pytest.raises(ContractError):
        enforce_contract(df, contract_schema({"a": "string", "b": "bigint"}))
    with pytest.raises(ContractError):
        enforce_contract(df, contract_schema({"a": "string"}))


def _typed(spark):
    T = dt.datetime
    return spark.createDataFrame([
        ("v1", T(2024, 1, 1), None, "USED_CAR"), ("v1", T(2024, 1, 2), "new", "DEMO_CAR"),
        ("v2", T(2024, 1, 1), "old", None), ("v2", T(2024, 1, 1), "old", "COMMISSION_CAR"),
    ], "inventory_id string, event_timestamp timestamp_ntz, vehicle_condition string, vehicle_type string")


def test_audits_return_violating_rows(spark):
    df = _typed(spark)
    keys = ["inventory_id", "event_timestamp"]
    assert audit_not_null(df, "vehicle_condition", keys).count() == 1
    bad = audit_accepted_values(df, "vehicle_type", ["USED_CAR", "COMMISSION_CAR"], keys)
    assert [r["vehicle_type"] for r in bad.collect()] == ["DEMO_CAR"]   # null passes
    assert [r["row_count"] for r in audit_unique(df, keys).collect()] == [2]


def test_run_audits_one_summary(spark):
    df = _typed(spark)
    out = {r["audit"]: r["violations"] for r in run_audits(df, [
        Audit("nn", "not_null", "vehicle_condition"),
        Audit("av", "accepted_values", "vehicle_type", ("USED_CAR", "COMMISSION_CAR")),
        Audit("uq", "unique", keys=("inventory_id", "event_timestamp"))]).collect()}
    assert out == {"nn": 1, "av": 1, "uq": 2}


def test_table_diff_classes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "z"), (4, "w")], "k int, v string")
    got = {r["k"]: r["change"] for r in table_diff(a, b, ["k"]).collect()}
    assert got == {2: "removed", 3: "changed", 4: "added"}
