"""Silver cleaning: typing, standardising, dedup and quarantine.

One declarative :class:`EntitySpec` per entity replaces a hand-written notebook
per entity.  ``clean(df, spec)`` returns ``(valid, quarantined)``; both come
from one lazily shared plan.  To evaluate the dedup shuffle only once at scale,
write them through :func:`strata.sources.sinks.write_split`.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import scalar as S

VALID_FLAG = "_is_valid"


@dataclass
class Rule:
    """A named validity predicate; a row passes when it is TRUE (NULL fails)."""

    name: str
    predicate: Column


@dataclass
class EntitySpec:
    """How one entity is typed, standardised, deduplicated and validated.

    ``casts`` maps column -> 'int' | 'double' | 'timestamp'.  ``order_col`` is
    the "latest wins" column of the dedup; ``tie_break`` completes it to a total
    order (default: every other column, descending).  ``validate_first``
    quarantines before dedup (the customer feed) instead of after (the five
    cleaners), see trap T2.
    """

    name: str
    keys: list[str]
    rules: list[Rule]
    reason: str
    trims: list[str] = field(default_factory=list)
    uppers: list[str] = field(default_factory=list)
    casts: dict[str, str] = field(default_factory=dict)
    order_col: str | None = None
    tie_break: list[str] | None = None
    validate_first: bool = False
    trim_keys: bool = False


_CASTS = {"int": S.to_int, "double": S.to_double, "timestamp": S.to_timestamp}
# a column of these types has no zone in its text, so it need not be written out and searched for one
_TIMES = ("date", "timestamp", "timestamp_ntz")


def trim_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Trim the given string columns and map '' to NULL, in one projection."""
    return df.withColumns({c: S.trim_to_null(c) for c in columns})


def standardise(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """P1-P3 as a single projection (stays inside one codegen stage)."""
    exprs: dict[str, Column] = {}
    if spec.trim_keys:  # keys are not trimmed unless asked (trap T6)
        for c in spec.keys:
            exprs[c] = S.trim_to_null(c)
    for c in spec.trims:
        exprs[c] = S.trim_to_null(c)
    for c in spec.uppers:
        exprs[c] = S.upper_trim(c)
    for c, kind in spec.casts.items():
        timed = kind == "timestamp" and c not in exprs and df.schema[c].dataType.typeName() in _TIMES
        exprs[c] = F.col(c).try_cast("timestamp_ntz") if timed else _CASTS[kind](c)
    return df.withColumns(exprs) if exprs else df


def total_order(
    df: DataFrame,
    keys: list[str],
    order_col: str | None,
    tie_break: list[str] | None = None,
) -> list[Column]:
    """Order column desc, then tie-break columns desc (NULLs last).

    The default tie-break is every other orderable column, which makes the
    winner a function of the row contents only: input order, partition count
    and re-evaluation can never pick a different row.
    """
    if tie_break is None:
        orderable = {
            f.name
            for f in df.schema.fields
            if f.dataType.typeName() not in ("map", "variant")
        }
        tie_break = [
            c for c in df.columns if c not in keys and c != order_col and c in orderable
        ]
    order = [F.col(order_col).desc_nulls_last()] if order_col else []
    if "batch_id" in tie_break:
        # A later batch wins a tie on the order column (trap T1); batch_10 is later than batch_9.
        order.append(S.natural_order("batch_id").desc_nulls_last())
    return order + [F.col(c).desc_nulls_last() for c in tie_break]


def dedup_latest(
    df: DataFrame,
    keys: list[str],
    order_col: str | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Keep the latest row per key.

    ``row_number() = 1`` is planned by Spark as a window group limit that runs
    on both sides of the shuffle, so each map task forwards at most one row per
    key: a hot key is reduced before it is shuffled.
    """
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order_col, tie_break))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def all_rules(rules: list[Rule]) -> Column:
    """Conjunction of rules where NULL counts as a failure."""
    return reduce(lambda a, b: a & b, [F.coalesce(r.predicate, F.lit(False)) for r in rules])


def failed_rules(rules: list[Rule]) -> Column:
    """Comma-joined names of the rules a row fails (NULL-safe)."""
    return F.concat_ws(
        ",",
        *[F.when(~F.coalesce(r.predicate, F.lit(False)), F.lit(r.name)) for r in rules],
    )


def tag_validity(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate the rules once into a boolean column (the basis of P8)."""
    return df.withColumn(VALID_FLAG, all_rules(rules))


def split_quarantine(
    df: DataFrame,
    rules: list[Rule] | Column,
    reason: str,
    quarantine_ts: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Complete split into (valid, quarantined).

    ``valid`` holds rows where every rule is TRUE; ``quarantined`` holds every
    other row (FALSE or NULL), with ``quarantine_reason``, the failing rule
    names and ``quarantine_timestamp``.  Pass ``quarantine_ts=None`` to omit
    the timestamp (deterministic query output).
    """
    if isinstance(rules, Column):
        rules = [Rule("condition", rules)]
    tagged = tag_validity(df, rules)
    valid = tagged.where(F.col(VALID_FLAG)).drop(VALID_FLAG)
    bad = tagged.where(~F.col(VALID_FLAG)).drop(VALID_FLAG).withColumns(
        {"quarantine_reason": F.lit(reason), "failed_rules": failed_rules(rules)}
    )
    if quarantine_ts is not None:
        bad = bad.withColumn("quarantine_timestamp", quarantine_ts)
    return valid, bad


def split_tagged(
    tagged: DataFrame, rules: list[Rule], reason: str, quarantine_ts: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """P8 on a frame that already carries the validity flag."""
    valid = tagged.where(F.col(VALID_FLAG)).drop(VALID_FLAG)
    bad = tagged.where(~F.col(VALID_FLAG)).drop(VALID_FLAG).withColumns(
        {"quarantine_reason": F.lit(reason), "failed_rules": failed_rules(rules)}
    )
    if quarantine_ts is not None:
        bad = bad.withColumn("quarantine_timestamp", quarantine_ts)
    return valid, bad


def clean_tagged(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """P13 up to the validity flag: standardise -> dedup -> tag.

    Both outputs of the split derive from this one frame, so persisting (or
    writing) it evaluates the dedup shuffle once for valid and quarantine.
    """
    typed = standardise(df, spec)
    return tag_validity(dedup_latest(typed, spec.keys, spec.order_col, spec.tie_break), spec.rules)


def clean(
    df: DataFrame,
    spec: EntitySpec,
    quarantine_ts: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Standardise -> dedup -> validate (or validate -> dedup)."""
    if spec.validate_first:
        valid, bad = split_quarantine(standardise(df, spec), spec.rules, spec.reason, quarantine_ts)
        return dedup_latest(valid, spec.keys, spec.order_col, spec.tie_break), bad
    return split_tagged(clean_tagged(df, spec), spec.rules, spec.reason, quarantine_ts)


# ---------------------------------------------------------------------------
# The six entities of the retail model.
# Fixed values (must equal the source model): accepted order statuses, accepted
# inventory event types, and the quarantine reason texts.
ACCEPTED_STATUSES = ["COMPLETED", "PENDING", "CANCELLED"]
ACCEPTED_EVENT_TYPES = ["INBOUND", "OUTBOUND", "ADJUSTMENT"]
REASON_PRODUCTS = "null product_id / missing or negative unit_price"
REASON_WAREHOUSES = "null warehouse_id or warehouse_name"
REASON_ORDERS = "null keys / invalid timestamp / unaccepted status"
REASON_ORDER_ITEMS = "null keys / non-positive quantity / negative price"
REASON_INVENTORY = "null keys / invalid type / sign rule violation"
REASON_CUSTOMERS = "null customer_id, updated_at, or batch_id"
# ---------------------------------------------------------------------------


def _nn(c: str) -> Rule:
    return Rule(f"{c}_not_null", F.col(c).isNotNull())


def products_spec() -> EntitySpec:
    return EntitySpec(
        name="products",
        keys=["product_id"],
        trims=["product_name", "category"],
        casts={"unit_price": "double", "updated_at": "timestamp"},
        order_col="updated_at",
        rules=[
            _nn("product_id"),
            _nn("unit_price"),
            Rule("unit_price_non_negative", F.col("unit_price") >= 0),
            Rule("unit_price_in_range", F.col("unit_price").isNull() | (F.col("unit_price") <= S.MAX_PRICE)),
        ],
        reason=REASON_PRODUCTS,
    )


def warehouses_spec() -> EntitySpec:
    return EntitySpec(
        name="warehouses",
        keys=["warehouse_id"],
        trims=["warehouse_name", "city", "region"],
        order_col="ingestion_timestamp",
        rules=[_nn("warehouse_id"), _nn("warehouse_name")],
        reason=REASON_WAREHOUSES,
    )


def orders_spec() -> EntitySpec:
    return EntitySpec(
        name="orders",
        keys=["order_id"],
        uppers=["status"],
        casts={"order_timestamp": "timestamp"},
        order_col="ingestion_timestamp",
        rules=[
            _nn("order_id"),
            _nn("customer_id"),
            _nn("order_timestamp"),
            Rule("status_accepted", F.col("status").isin(ACCEPTED_STATUSES)),
        ],
        reason=REASON_ORDERS,
    )


def order_items_spec() -> EntitySpec:
    return EntitySpec(
        name="order_items",
        keys=["order_item_id"],
        casts={"quantity": "int", "unit_price": "double"},
        order_col="ingestion_timestamp",
        rules=[
            _nn("order_item_id"),
            _nn("order_id"),
            _nn("product_id"),
            _nn("quantity"),
            Rule("quantity_positive", F.col("quantity") > 0),
            Rule("unit_price_non_negative", F.col("unit_price") >= 0),
            Rule("unit_price_in_range", F.col("unit_price").isNull() | (F.col("unit_price") <= S.MAX_PRICE)),
        ],
        reason=REASON_ORDER_ITEMS,
    )


def sign_rule() -> Column:
    """INBOUND > 0, OUTBOUND < 0, ADJUSTMENT either sign."""
    et, q = F.col("event_type"), F.col("quantity_change")
    return (
        ((et == "INBOUND") & (q > 0))
        | ((et == "OUTBOUND") & (q < 0))
        | (et == "ADJUSTMENT")
    )


def inventory_events_spec() -> EntitySpec:
    return EntitySpec(
        name="inventory_events",
        keys=["event_id"],
        uppers=["event_type"],
        casts={"quantity_change": "int", "event_timestamp": "timestamp"},
        order_col="event_timestamp",
        rules=[
            _nn("event_id"),
            _nn("event_timestamp"),
            Rule("event_type_accepted", F.col("event_type").isin(ACCEPTED_EVENT_TYPES)),
            _nn("quantity_change"),
            Rule("sign_rule", sign_rule()),
        ],
        reason=REASON_INVENTORY,
    )


def with_order_col(spec: EntitySpec, order_col: str | None) -> EntitySpec:
    """Copy of a spec with another "latest wins" column (stand-in sources)."""
    return EntitySpec(**{**spec.__dict__, "order_col": order_col})
