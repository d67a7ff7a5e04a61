"""Column expressions (F1-F16).  Each returns a Column; none is a UDF.

Typing never aborts a job: malformed input becomes NULL via ``try_cast`` so the
cleaners can route the row to quarantine instead of failing the run (ANSI mode
is on by default and a plain ``cast`` would raise).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end-of-time sentinel that marks an open (current) version.
END_OF_TIME = "9999-12-31 23:59:59"
# The largest price that the amount's decimal arithmetic holds; NaN compares above it.
MAX_PRICE = 99_999_999_999_999.0


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_to_null(c: str | Column) -> Column:
    """Trim, and turn the empty string into NULL."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def upper_trim(c: str | Column) -> Column:
    """Canonical upper-case code."""
    return F.upper(F.trim(as_col(c)))


def to_int(c: str | Column) -> Column:
    """string -> int; malformed -> NULL."""
    return as_col(c).try_cast("int")


def to_double(c: str | Column) -> Column:
    """string -> double; malformed -> NULL."""
    return as_col(c).try_cast("double")


def to_timestamp(c: str | Column) -> Column:
    """string -> zone-free timestamp in UTC; malformed -> NULL.

    A text with a zone, as an offset or by name (``+02:00``, ``Z``,
    ``Europe/Paris``, ``PST``), is moved to UTC, whatever the session zone; with
    a name that is no zone it is malformed.  One without is taken as it stands.
    """
    text = as_col(c).cast("string")
    # whole microseconds since the epoch know no zone, nor hours that a zone has twice
    seconds = (F.unix_micros(text.try_cast("timestamp")) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    zoned = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.when(text.rlike(r":\d{1,2}(\.\d*)?\s*[^\s\d:.]"), zoned).otherwise(as_col(c).try_cast("timestamp_ntz"))


def natural_order(c: str | Column) -> Column:
    """A text's sorting key in which runs of digits compare as numbers: first by length, then by digits."""
    parts = F.regexp_extract_all(as_col(c), F.lit(r"(\d+|\D+)"), F.lit(1))

    def key(x: Column) -> Column:
        digits = F.ltrim(x, F.lit("0"))
        return F.when(x.rlike(r"^\d"), F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)).otherwise(x)

    return F.array_join(F.transform(parts, key), "")


def end_of_time() -> Column:
    return F.lit(END_OF_TIME).cast("timestamp_ntz")


def surrogate_key(*cols: str | Column) -> Column:
    """stable hash key md5(concat_ws('|', parts)); NULL parts are skipped."""
    return F.md5(F.concat_ws("|", *[as_col(c).cast("string") for c in cols]))


def version_key(key: str | Column, start: str | Column) -> Column:
    """H6: key of one version = md5(key | start rendered as text)."""
    return surrogate_key(key, as_col(start).cast("string"))


def date_key(ts: str | Column) -> Column:
    """yyyyMMdd integer key of a timestamp or date."""
    return F.date_format(as_col(ts), "yyyyMMdd").cast("int")


def line_amount(quantity: str | Column, unit_price: str | Column) -> Column:
    """round(quantity * price, 2) computed in decimal, returned as double.

    The price is taken at six decimals so a price with more than two decimals is
    rounded once, on the product, exactly as ROUND(q * p, 2) intends.  A value
    that does not fit gives NULL, which the amount check counts; Silver keeps
    prices above MAX_PRICE, infinite ones and NaN out.
    """
    q = as_col(quantity).try_cast("decimal(12,0)")
    p = as_col(unit_price).try_cast("decimal(20,6)")
    return F.round(q * p, 2).cast("double")
