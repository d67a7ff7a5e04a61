"""Type-2 history (H1-H7) as one window plan instead of a per-batch loop.

Full rebuild (H2-H6):

1. batch order ``(min(ts) per batch, batch_id)`` from a tiny aggregate joined
   back (AQE broadcasts it once its real size is known);
2. latest row per ``(batch, key)`` (window group limit, reduced map-side);
3. over ``partitionBy(key).orderBy(batch order)`` keep a row if it is the
   key's first or any tracked column differs null-safely from the previous row;
4. over the kept rows: ``end = lead(start)`` or end-of-time, current = last.

Comparing with the previous *row* equals comparing with the previous *kept
version*: a dropped row equals the version before it, and null-safe equality
is transitive.  After step 2 a key holds at most one row per batch, so even a
key with a third of all feed rows is small by the time it is shuffled by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import scalar as S
from strata.operators.clean import REASON_CUSTOMERS, Rule, dedup_latest, split_quarantine

START = "effective_start_timestamp"
END = "effective_end_timestamp"
CURRENT = "is_current"
BATCH_TS = "_batch_ts"

# Tracked attributes of the customer entity.
CUSTOMER_TRACKED = ["email", "customer_name", "segment", "city", "region"]


def prepare_feed(
    df: DataFrame,
    key: str = "customer_id",
    ts_col: str = "updated_at",
    batch_col: str = "batch_id",
    tracked: list[str] = CUSTOMER_TRACKED,
    reason: str = REASON_CUSTOMERS,
    quarantine_ts: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """H1: trim tracked columns, parse the change time, quarantine rows without
    key, time or batch *before* any dedup."""
    typed = df.withColumns({c: S.trim_to_null(c) for c in tracked}).withColumn(
        ts_col, S.to_timestamp(ts_col)
    )
    rules = [
        Rule(f"{key}_not_null", F.col(key).isNotNull()),
        Rule(f"{ts_col}_not_null", F.col(ts_col).isNotNull()),
        Rule(f"{batch_col}_not_null", F.col(batch_col).isNotNull()),
    ]
    return split_quarantine(typed, rules, reason, quarantine_ts)


def order_batches(feed: DataFrame, batch_col: str, ts_col: str) -> DataFrame:
    """H2/A4: one row per batch with its ordering timestamp min(ts).

    The result has one row per batch, so it is joined back rather than
    computed with a window over the (possibly huge) batch partition.
    """
    return feed.groupBy(batch_col).agg(F.min(ts_col).alias(BATCH_TS))


def dedup_within_batch(
    feed: DataFrame,
    key: str,
    ts_col: str,
    batch_col: str,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """H3: latest row per (batch, key); ties broken by the other columns."""
    return dedup_latest(feed, [batch_col, key], ts_col, tie_break)


def _differs(tracked: list[str], w: Window) -> Column:
    """Any tracked column not null-safely equal to the previous row's."""
    if not tracked:
        return F.lit(False)
    return reduce(
        lambda a, b: a | b,
        [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in tracked],
    )


def version_order(ts_col: str, batch_col: str, order_by: str = "batch") -> list[Column]:
    """Order of a key's versions.

    ``'batch'`` (the default, as the source system): batches in
    ``(min ts, batch_id)`` order, so a late batch can close a version with an
    end before its start (trap T7, reported by the quality suite).
    ``'event_time'``: the change time itself, batch order only breaking ties,
    so late data slots into its place in time.
    """
    if order_by == "event_time":
        return [F.col(ts_col), F.col(BATCH_TS), F.col(batch_col)]
    if order_by != "batch":
        raise ValueError(f"order_by must be 'batch' or 'event_time', not {order_by!r}")
    return [F.col(BATCH_TS), F.col(batch_col)]


def detect_changes(
    feed: DataFrame,
    key: str = "customer_id",
    ts_col: str = "updated_at",
    batch_col: str = "batch_id",
    tracked: list[str] = CUSTOMER_TRACKED,
    tie_break: list[str] | None = None,
    order_by: str = "batch",
    order: DataFrame | None = None,
) -> DataFrame:
    """H2-H4: rows that open a new version (new key or changed attributes).

    Output keeps the feed columns plus ``_batch_ts``.  ``order`` may pass the
    batch order of a larger feed of which this is a part.
    """
    latest = dedup_within_batch(feed, key, ts_col, batch_col, tie_break)
    ordered = latest.join(order if order is not None else order_batches(feed, batch_col, ts_col), batch_col, "inner")
    w = Window.partitionBy(key).orderBy(*version_order(ts_col, batch_col, order_by))
    is_first = F.lag(F.lit(1)).over(w).isNull()
    return (
        ordered.withColumn("_opens", is_first | _differs(tracked, w))
        .where(F.col("_opens"))
        .drop("_opens")
    )


def versions_from_changes(
    changes: DataFrame,
    key: str = "customer_id",
    ts_col: str = "updated_at",
    batch_col: str = "batch_id",
    tracked: list[str] = CUSTOMER_TRACKED,
    sk_col: str = "customer_sk",
    order_by: str = "batch",
) -> DataFrame:
    """H5/H6: chain kept rows into half-open ``[start, end)`` versions."""
    w = Window.partitionBy(key).orderBy(*version_order(ts_col, batch_col, order_by))
    nxt = F.lead(ts_col).over(w)
    return changes.select(
        S.version_key(key, ts_col).alias(sk_col),
        F.col(key),
        *[F.col(c) for c in tracked],
        F.col(ts_col).alias(START),
        F.coalesce(nxt, S.end_of_time()).alias(END),
        nxt.isNull().alias(CURRENT),
    )


def build_history(
    feed: DataFrame,
    key: str = "customer_id",
    ts_col: str = "updated_at",
    batch_col: str = "batch_id",
    tracked: list[str] = CUSTOMER_TRACKED,
    sk_col: str = "customer_sk",
    tie_break: list[str] | None = None,
    order_by: str = "batch",
    order: DataFrame | None = None,
) -> DataFrame:
    """H2-H6: the complete version history of a prepared (typed) feed."""
    changes = detect_changes(feed, key, ts_col, batch_col, tracked, tie_break, order_by, order)
    return versions_from_changes(changes, key, ts_col, batch_col, tracked, sk_col, order_by)


def late_keys(batches: DataFrame, feed: DataFrame, key: str, ts_col: str, batch_col: str) -> tuple[DataFrame, DataFrame]:
    """Keys with a row in a batch that sorts before the last one already applied, and the order of all batches."""
    order = order_batches(feed.select(batch_col, ts_col).unionByName(batches.select(batch_col, ts_col)), batch_col, ts_col)
    place = F.struct(BATCH_TS, batch_col)
    last = order.join(feed.select(batch_col).distinct(), batch_col, "left_semi").agg(F.max(place).alias("_last"))
    late = order.join(batches.select(batch_col).distinct(), batch_col, "left_semi").join(last, place <= F.col("_last"), "left_semi")
    return batches.join(late.select(batch_col), batch_col, "left_semi").select(key).distinct(), order


def apply_batches(
    history: DataFrame,
    batches: DataFrame,
    feed: DataFrame | None = None,
    key: str = "customer_id",
    ts_col: str = "updated_at",
    batch_col: str = "batch_id",
    tracked: list[str] = CUSTOMER_TRACKED,
    sk_col: str = "customer_sk",
    tie_break: list[str] | None = None,
    order: DataFrame | None = None,
) -> DataFrame:
    """H7: apply any number of new batches to an existing history in one plan, without MERGE.

    Each key's current version and its new rows go through one window: a row
    that differs (null-safely) from the one before it opens a version and
    closes the last.  Closed versions pass through untouched, so the plan reads
    the history twice (current, closed) however many batches there are, and
    replaying a batch adds nothing.

    A *late* batch sorts before one already applied, and closed versions no
    longer hold the rows that changed nothing then.  With ``feed``, the rows
    applied so far, the keys of late batches are rebuilt from it and the result
    equals a full rebuild; without it every batch must be later than all applied.
    ``order`` may pass the order of the batches, where ``batches`` is a part of them.
    """
    if feed is not None:
        keys, order = late_keys(batches, feed, key, ts_col, batch_col)
        columns = [key, ts_col, batch_col, *tracked]
        every = feed.select(*columns).unionByName(batches.select(*columns)).join(keys, key, "left_semi")
        rebuilt = build_history(every, key, ts_col, batch_col, tracked, sk_col, tie_break, order=order)
        rest = apply_batches(
            history.join(keys, key, "left_anti"), batches.join(keys, key, "left_anti"), None, key, ts_col, batch_col, tracked, sk_col, tie_break, order
        )
        return rest.unionByName(rebuilt.select(*rest.columns))
    latest = dedup_within_batch(batches, key, ts_col, batch_col, tie_break).join(order if order is not None else order_batches(batches, batch_col, ts_col), batch_col)
    new = latest.select(key, ts_col, *tracked, BATCH_TS, batch_col, F.lit(True).alias("_new"))
    current = history.where(F.col(CURRENT)).select(
        key, F.col(START).alias(ts_col), *tracked,
        F.lit(None).cast(new.schema[BATCH_TS].dataType).alias(BATCH_TS),
        F.lit(None).cast(new.schema[batch_col].dataType).alias(batch_col),
        F.lit(False).alias("_new"),
    )
    w = Window.partitionBy(key).orderBy("_new", BATCH_TS, batch_col)
    opens = ~F.col("_new") | F.lag(F.lit(1)).over(w).isNull() | _differs(tracked, w)
    changes = current.unionByName(new).withColumn("_opens", opens).where(F.col("_opens"))
    following = F.lead(ts_col).over(w)
    versions = changes.select(
        S.version_key(key, ts_col).alias(sk_col),
        F.col(key),
        *[F.col(c) for c in tracked],
        F.col(ts_col).alias(START),
        F.coalesce(following, S.end_of_time()).alias(END),
        following.isNull().alias(CURRENT),
    )
    return history.where(~F.col(CURRENT)).unionByName(versions.select(*history.columns))


def apply_batch(history: DataFrame, batch: DataFrame, *args, **kw) -> DataFrame:
    """:func:`apply_batches` for one batch without a batch column."""
    return apply_batches(history, batch.withColumn("batch_id", F.lit("new")), None, *args, **kw)
