"""Relational operators built from DataFrame primitives."""

from stockroom.operators.filters import (
    drop_null_key, valid_spans, in_interval, interval_predicate, high_water_mark,
    above_mark, not_accepted, is_null,
)
from stockroom.operators.latest import (
    latest_per_key, dedup_redelivery, latest_attributes, first_over_full_frame,
)
from stockroom.operators.spans import validity_span, expand_days, daily_stock
from stockroom.operators.enrich import (
    left_join_dimension, left_join_entity, assert_unique, bounded_count, bounded_size,
    DuplicateKeyError,
)
from stockroom.operators.quality import (
    Audit, ContractError, VEHICLE_AUDITS, audit_accepted_values, audit_not_null,
    audit_unique, contract_schema, enforce_contract, run_audits, table_diff,
)

__all__ = [n for n in dir() if not n.startswith("_")]
