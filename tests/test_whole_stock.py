"""The sweep query returns the whole daily stock: every day and every measure."""

import datetime as dt

import duckdb
import pytest

from stockroom.oracle import ORACLE
from stockroom.registry import QUERIES
from tests.conftest import rows

COUNTS = ("published_net_stock_count", "net_stock_count", "online_orderable_count", "approved_count", "stock_days")


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Three vehicles: one in stock before, on and after 10 to 20 January, one
    in stock in March only, one on one day between."""
    sf = tmp_path_factory.mktemp("stock")
    t = lambda m, d: dt.datetime(2024, m, d, 9)
    made = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"c{k}", 0, 0.0, "S") for k in (1, 2, 3)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "events": ([(2, t(1, 5), 1, "view", 0.0, "{}"), (3, t(1, 25), 1, "view", 0.0, "{}"),
                    (8, t(3, 1), 2, "view", 0.0, "{}"), (10, t(3, 2), 2, "view", 0.0, "{}"),
                    (1, t(1, 12), 3, "view", 0.0, "{}")],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{sf}/{name}.parquet")
    return sf


def test_sweep_returns_every_day_and_measure(spark, small):
    got = {(r["stock_date"], r["dealer_name"]): tuple(r[c] for c in COUNTS)
           for r in QUERIES["cdp_demo_sweep"](spark, str(small)).collect()}
    # Latest events: 3 (dealer 3, not orderable by default, approved), 10 (dealer 0, orderable,
    # approved), 1 (dealer 1, orderable, not approved).
    want = {(dt.date(2024, 1, 5) + dt.timedelta(n), "Dealer 3"): (1, 1, 0, 1, n) for n in range(21)}
    want |= {(dt.date(2024, 3, 1 + n), "Dealer 0"): (1, 1, 1, 1, n) for n in range(2)}
    want[dt.date(2024, 1, 12), "Dealer 1"] = (1, 1, 1, 0, 0)
    assert got == want


def test_sweep_equals_explode_and_its_sql_on_small_tables(spark, small):
    sweep = QUERIES["cdp_demo_sweep"](spark, str(small))
    assert rows(sweep) == rows(QUERIES["cdp_demo_explode"](spark, str(small)).select(sweep.columns))
    with duckdb.connect() as con:
        for t in ("region", "nation", "customer", "events"):
            con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet/*.parquet')")
        rel = con.sql(ORACLE["cdp_demo_sweep"]).select(*sweep.columns)
        assert rows(sweep) == sorted(rel.fetchall(), key=repr)
