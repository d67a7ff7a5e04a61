"""Join operators (J1-J10) beyond a plain ``df.join``.

None of them emits all pairs inside a key: the point-in-time join matches at
most one version per fact row (half-open windows), and the overlap check is a
running-max window instead of a self join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata.operators.history import CURRENT, END, START


SALT = "_salt"


def hot_keys(facts: DataFrame, key: str, fraction: float) -> DataFrame:
    """Keys holding at least ``fraction`` of all fact rows, as a table of its own.

    At most ``1 / fraction`` keys can qualify, so the result has a proven size
    bound and may be broadcast.  The per-key count is a partial (map-side)
    aggregate, so a hot key is counted without being gathered in one task.  The
    keys are counted here, once, whatever number of plans uses the table.
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"a share of the rows must be above 0 and at most 1, not {fraction}")
    seen = Observation("rows by key")
    counts = facts.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("rows"))
    largest = counts.orderBy(F.desc("_n")).limit(int(1 / fraction) + 1).collect()
    rows = seen.get["rows"] or 0
    hot = [(r["_hot_key"],) for r in largest if r["_n"] >= rows * fraction and r["_hot_key"] is not None]
    return facts.sparkSession.createDataFrame(hot, StructType([StructField("_hot_key", facts.schema[key].dataType)]))


def salt_hot_keys(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    fraction: float,
    buckets: int,
    hot: DataFrame | None = None,
    spread: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Spread each hot key over ``buckets`` join partitions.

    A hot fact row gets a salt from a hash of the whole row, or of its columns
    ``spread`` (deterministic, so a recomputed task puts every row in the same
    bucket again); the versions of
    a hot key are copied once per bucket; every other key keeps salt 0 and a
    single copy.  Only the versions of at most ``1 / fraction`` keys are
    replicated.
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"a share of the rows must be above 0 and at most 1, not {fraction}")
    if hot is None:
        hot = F.broadcast(hot_keys(facts, fact_key, fraction))  # at most 1 / fraction rows
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in spread or facts.columns])
    f = facts.join(hot, facts[fact_key] == hot["_hot_key"], "left").select(
        *[facts[f"`{c}`"] for c in facts.columns],
        F.when(F.col("_hot_key").isNotNull(), F.pmod(row_hash, F.lit(buckets)))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias(SALT),
    )
    v = versions.join(hot, versions[version_key] == hot["_hot_key"], "left").select(
        *[versions[f"`{c}`"] for c in versions.columns],
        F.explode(
            F.when(F.col("_hot_key").isNotNull(), F.sequence(F.lit(0), F.lit(buckets - 1)))
            .otherwise(F.array(F.lit(0)))
            .cast("array<bigint>")
        ).alias("_v_salt"),
    )
    return f, v


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    fact_ts: str,
    start: str = START,
    end: str = END,
    how: str = "left",
    skew_fraction: float | None = None,
    salt_buckets: int = 32,
    hot: DataFrame | None = None,
    spread: list[str] | None = None,
) -> DataFrame:
    """As-of join on ``key = key AND start <= ts < end``.

    Planned as a sort-merge (or, when AQE measures the versions side as small,
    broadcast hash) join on the key with the range as a residual; no range is
    exploded and at most one version matches a row.  The versions of one key
    are bounded by the number of batches.

    Hot keys: AQE splits a skewed partition when both join inputs are plain
    shuffles (e.g. a dimension read from its table).  With ``skew_fraction``
    set, keys holding at least that fraction of the facts are additionally
    salted over ``salt_buckets`` partitions (see :func:`salt_hot_keys`), which
    works whatever the shape of the inputs.  ``hot`` may pass keys counted on a
    cheaper upstream column; a key more or less there changes the plan, never
    the rows.  Facts without a key are spread (see :func:`spread_null_keys`).
    ``spread`` names the columns that tell the facts apart: with their own key
    the salt does not hold the other columns in the plan of a query that needs
    none of them.  ``versions`` must carry distinct column names.
    """
    f, v = spread_null_keys(facts, versions, fact_key, version_key, skew_fraction, salt_buckets, hot, spread)
    cond = (f[fact_key] == v[version_key]) & (f[SALT] == v["_v_salt"]) & (f[fact_ts] >= v[start]) & (f[fact_ts] < v[end])
    return f.join(v, cond, how).drop(SALT, "_v_salt")


NULL_SPREAD = 4096  # join partitions that rows without a key are dealt to, at most


def spread_null_keys(
    facts: DataFrame, other: DataFrame, fact_key: str, other_key: str, skew_fraction: float | None, salt_buckets: int,
    hot: DataFrame | None, spread: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a salt as a second key.

    A NULL key matches nothing, yet a left join keeps the row, and rows that
    are dealt by that key alone all go to one task.  Such a row gets a negative
    salt from a hash of itself (or of its columns ``spread``), which no row of the other side has: the rows
    are spread, in the one plan and the one shuffle of all the others.  Every
    other row has salt 0, or that of its hot key (:func:`salt_hot_keys`).
    """
    if skew_fraction:
        f, v = salt_hot_keys(facts, other, fact_key, other_key, skew_fraction, salt_buckets, hot, spread)
    else:
        # zero on the other side as well, but not a constant, which the optimizer would take out of the join's keys
        f, v = facts.withColumn(SALT, F.lit(0).cast("bigint")), other.withColumn("_v_salt", F.pmod(F.xxhash64(other_key), F.lit(1)).cast("bigint"))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in spread or facts.columns])
    salt = F.when(F.col(f"`{fact_key}`").isNull(), -1 - F.pmod(row_hash, F.lit(NULL_SPREAD))).otherwise(F.col(SALT))
    return f.withColumn(SALT, salt), v


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "left",
    skew_fraction: float | None = None,
    salt_buckets: int = 32,
    hot: DataFrame | None = None,
    spread: list[str] | None = None,
) -> DataFrame:
    """Equi lookup of a Type-1 dimension (one row per key on the dim side).

    AQE broadcasts the dimension when its measured size allows; otherwise it
    is a sort-merge join, and with ``skew_fraction`` set the keys holding at
    least that share of the facts are salted as in the point-in-time join.
    ``hot`` may pass precomputed hot keys (column ``_hot_key``), e.g. counted
    on a cheaper upstream column with the same distribution.  Facts without a
    key are spread (see :func:`spread_null_keys`), by a hash of ``spread``.
    """
    f, d = spread_null_keys(facts, dim, fact_key, dim_key, skew_fraction, salt_buckets, hot, spread)
    return f.join(d, (f[fact_key] == d[dim_key]) & (f[SALT] == d["_v_salt"]), how).drop(SALT, "_v_salt")


def naive_key_join(
    facts: DataFrame, versions: DataFrame, fact_key: str, version_key: str
) -> DataFrame:
    """Key-only join (negative control that shows the fan-out)."""
    return facts.join(versions, facts[fact_key] == versions[version_key], "left")


def unresolved_foreign_keys(
    facts: DataFrame, fk: str, dim: DataFrame, dim_key: str
) -> DataFrame:
    """Fact rows whose key has no dimension row (a NULL key counts)."""
    d = dim.select(F.col(dim_key).alias("_dk")).distinct()
    return facts.join(d, facts[fk] == d["_dk"], "left_anti")


def keys_with_current_count(history: DataFrame, key: str) -> DataFrame:
    """Per key: number of versions and number of current versions (one pass)."""
    return history.groupBy(key).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col(CURRENT)).alias("current_versions"),
    )


def keys_without_current(history: DataFrame, key: str) -> DataFrame:
    """Keys with no current version, as an aggregate (not NOT IN)."""
    return keys_with_current_count(history, key).where(F.col("current_versions") == 0)


def overlapping_versions(
    history: DataFrame,
    key: str,
    sk: str,
    start: str = START,
    end: str = END,
) -> DataFrame:
    """J7 (scale form): versions whose window starts before an earlier version
    of the same key has ended.

    Sorting a key's versions by start and keeping the running max of the
    previous ends finds every clash without a self join; each clash is
    reported once, on its later window.  Versions sharing a version key are
    compared too (uniqueness of that key is checked separately).  An empty
    window (start not before end) overlaps nothing; a check of its own reports
    it.
    """
    w = (
        Window.partitionBy(key)
        .orderBy(F.col(start), F.col(end), F.col(sk))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        history.withColumn("_prev_max_end", F.max(F.when(F.col(start) < F.col(end), F.col(end))).over(w))
        .where((F.col(start) < F.col(end)) & (F.col("_prev_max_end") > F.col(start)))
        .drop("_prev_max_end")
    )


def version_gaps(
    history: DataFrame, key: str, start: str = START, end: str = END
) -> DataFrame:
    """Versions whose end is not the next version's start."""
    w = Window.partitionBy(key).orderBy(F.col(start), F.col(end), *[F.col(c) for c in history.columns if c not in (key, start, end)])
    return (
        history.withColumn("next_start", F.lead(start).over(w))
        .where(F.col("next_start").isNotNull() & (F.col("next_start") != F.col(end)))
    )


def multi_version_keys(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one version (IN ... HAVING COUNT(*) > 1)."""
    return history.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(key)
