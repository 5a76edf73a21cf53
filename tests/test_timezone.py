"""Results do not depend on the session time zone (data is timestamp_ntz;
literals are built zone-free)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL, rows

TIME_SENSITIVE = ["interval_filter_ts", "hwm_strict_filter", "cdp_preview", "pad_open_span",
                  "sdp_incremental_hwm", "merge_by_key", "land_raw_projection"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_same_result_in_other_session_zone(spark, name):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        base = rows(E.queries()[name](spark, SF_SMALL))
        spark.conf.set(key, "America/Los_Angeles")
        shifted = rows(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set(key, before)
    assert base == shifted
