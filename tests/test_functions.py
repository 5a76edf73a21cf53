import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.functions import (
    day_array, days_between, default_if_null, json_fields, json_struct_fields, pad_open_end,
    to_bool, to_date,
)

DOCS = [
    ('{"v":{"id":"A","flag":true,"n":5,"o":{"x":"y"},"z":null}}',),
    ('{"v":{"id":"B","flag":"false"}}',),
    ('not json',),
    ('{"v":{}}',),
    (None,),
]
SPEC = {"id": "$.v.id", "flag": "$.v.flag", "n": "$.v.n", "obj": "$.v.o", "z": "$.v.z",
        "x": "$.v.o.x"}


def test_from_json_equals_get_json_object(spark):
    df = spark.createDataFrame(DOCS, "value string")
    a = json_fields(df, "value", SPEC).drop("value").collect()
    b = json_struct_fields(df, "value", SPEC).select(*SPEC).collect()
    assert a == b
    assert a[0]["flag"] == "true" and a[0]["n"] == "5" and a[0]["obj"] == '{"x":"y"}'
    assert a[0]["z"] is None and a[2]["id"] is None and a[4]["id"] is None


def test_parse_barrier_keeps_one_parse(spark):
    df = spark.createDataFrame(DOCS, "value string")
    out = json_struct_fields(df, "value", SPEC).where(F.col("id").isNotNull())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert [r["id"] for r in out.collect()] == ["A", "B"]


def test_strict_and_lenient_casts(spark):
    df = spark.createDataFrame([("junk",), ("2024-01-02",), ("yes",)], "s string")
    with pytest.raises(Exception):
        df.select(to_date("s")).collect()
    assert [r[0] for r in df.select(to_date("s", lenient=True)).collect()] == \
        [None, dt.date(2024, 1, 2), None]
    assert [r[0] for r in df.select(to_bool("s", lenient=True)).collect()] == [None, None, True]


def test_null_defaults(spark):
    df = spark.createDataFrame([(None,), (True,)], "b boolean")
    assert [r[0] for r in df.select(default_if_null("b", False)).collect()] == [False, True]
    df = spark.createDataFrame([(None,), (dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(pad_open_end("t", "2024-02-15 12:00:00")).collect()]
    assert got == [dt.datetime(2024, 2, 15, 12), dt.datetime(2024, 1, 1)]


def test_day_array_guards_backward_and_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3)),
                                (dt.date(2024, 1, 3), dt.date(2024, 1, 1)),
                                (None, dt.date(2024, 1, 1))], "s date, e date")
    got = [r[0] for r in df.select(day_array("s", "e")).collect()]
    assert got[0] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert got[1] is None and got[2] is None


def test_days_between_types(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 4))], "s date, e date")
    out = df.select(days_between("e", "s").alias("a"), days_between("e", "s", long=True).alias("b"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["int", "bigint"]
    assert tuple(out.first()) == (3, 3)
