"""Scalar column expressions shared by all layers (all JVM-side built-ins)."""

from strata.functions.scalar import (
    END_OF_TIME,
    as_col,
    date_key,
    end_of_time,
    line_amount,
    surrogate_key,
    to_double,
    to_int,
    to_timestamp,
    trim_to_null,
    upper_trim,
    version_key,
)

__all__ = [
    "END_OF_TIME",
    "as_col",
    "date_key",
    "end_of_time",
    "line_amount",
    "surrogate_key",
    "to_double",
    "to_int",
    "to_timestamp",
    "trim_to_null",
    "upper_trim",
    "version_key",
]
