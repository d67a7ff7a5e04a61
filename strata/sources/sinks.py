"""Sinks (S7-S13): overwrite/append writes that report their row count.

Counts come from an :class:`Observation` attached to the write itself, so no
table is read back to count it.  An overwrite of a folder is seen while it
happens; tables that others read are replaced through
:class:`strata.sources.store.Versions` instead (a fresh folder, then one
rename), as the pipeline and the functions of S10 and S13 below do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.clean import VALID_FLAG, failed_rules, tag_validity, Rule
from strata.sources.store import Versions

LAYERS = ["bronze", "silver", "gold", "quarantine"]


def write_counted(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    metrics: dict[str, Column] | None = None,
    observed: dict[str, int] | None = None,
) -> int:
    """Write ``df`` once and return the number of rows written.

    ``metrics`` are aggregates that the write observes as well; their values
    are put into ``observed``.

    An overwrite replaces every partition of the target, also those that get no
    rows this time, whatever the session's overwrite mode.
    """
    obs = Observation(f"rows_{abs(hash(target)) % 10**8}")
    more = {k: c.cast("bigint").alias(f"_m{i}") for i, (k, c) in enumerate((metrics or {}).items())}
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows"), *more.values()).write.mode(mode).format(fmt)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)
    got = obs.get
    if observed is not None:
        observed.update({k: int(got.get(f"_m{i}") or 0) for i, k in enumerate(more)})
    return int(got.get("rows", 0))


def write_bronze(df: DataFrame, target: str, **kw) -> int:
    """Overwrite a Bronze table, return its row count."""
    return write_counted(df, target, "overwrite", **kw)


def write_silver(df: DataFrame, target: str, processed_ts: Column | None = None, **kw) -> int:
    """Add ``silver_processed_timestamp`` and overwrite."""
    ts = processed_ts if processed_ts is not None else F.current_timestamp()
    return write_counted(df.withColumn("silver_processed_timestamp", ts), target, "overwrite", **kw)


def write_quarantine(df: DataFrame, target: str, **kw) -> int:
    """Overwrite a quarantine table."""
    return write_counted(df, target, "overwrite", **kw)


SPLIT_AUDIT = ["silver_processed_timestamp", "quarantine_reason", "failed_rules", "quarantine_timestamp"]


@dataclass
class SplitTable:
    """A Silver table and its quarantine, stored once as two partitions."""

    path: str
    columns: list[str]
    valid_rows: int
    quarantined_rows: int
    schema: StructType | None = None  # as written (no inference; works for empty writes)

    def _read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.schema(self.schema) if self.schema is not None else spark.read
        return reader.parquet(self.path)

    def valid(self, spark: SparkSession) -> DataFrame:
        flag = F.col(VALID_FLAG).cast("boolean")
        return self._read(spark).where(flag).select(*self.columns, "silver_processed_timestamp")

    def quarantined(self, spark: SparkSession) -> DataFrame:
        flag = F.col(VALID_FLAG).cast("boolean")
        return self._read(spark).where(~flag).select(
            *self.columns, "quarantine_reason", "failed_rules", "quarantine_timestamp"
        )


def write_split(
    df: DataFrame,
    rules: list[Rule],
    reason: str,
    target: str,
    run_ts: Column | None = None,
) -> SplitTable:
    """P8 + S8 + S9 at scale: the (deduplicated) plan is evaluated and written
    **once**.

    Rows are tagged with the validity flag and written partitioned by it, so
    the Silver table is the ``true`` partition and the quarantine table the
    ``false`` partition of one folder; readers prune to their partition.  The
    audit columns of each side are filled only on that side.  Both row counts
    come from one :class:`Observation` on the write.
    """
    ts = run_ts if run_ts is not None else F.current_timestamp()
    flag = F.col(VALID_FLAG)
    tagged = tag_validity(df, rules).withColumns(
        {
            "silver_processed_timestamp": F.when(flag, ts),
            "quarantine_reason": F.when(~flag, F.lit(reason)),
            "failed_rules": F.when(~flag, failed_rules(rules)),
            "quarantine_timestamp": F.when(~flag, ts),
        }
    )
    obs = Observation(f"split_{abs(hash(target)) % 10**8}")
    observed = tagged.observe(
        obs, F.count_if(flag).alias("valid"), F.count_if(~flag).alias("quarantined")
    )
    observed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(VALID_FLAG).parquet(target)
    got = obs.get
    data = [f for f in tagged.schema.fields if f.name != VALID_FLAG]
    schema = StructType(data + [f for f in tagged.schema.fields if f.name == VALID_FLAG])
    return SplitTable(
        target, list(df.columns), int(got.get("valid", 0)), int(got.get("quarantined", 0)), schema
    )


def replace_table_as(df: DataFrame, name: str, fmt: str = "parquet") -> int:
    """CREATE OR REPLACE TABLE ... AS SELECT for a catalog table.

    The rows go to a fresh folder beside the table's, and the catalog entry is
    pointed at it when they are all there: a reader, or a run that dies, finds
    the old table or the new one.  With the same columns that is one change of
    the entry; other columns need the entry made anew, two changes in a row.
    The folder replaced before the last one is removed.  A table that was not
    made here keeps its own folder.
    """
    spark = df.sparkSession
    schema, _, table = name.rpartition(".")
    base = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    versions = Versions(spark, f"{base.rstrip('/')}/_replaced")
    rows = write_counted(df, versions.stage(table), "overwrite", fmt=fmt)
    path, quoted = versions.path(table), ".".join(f"`{p}`" for p in name.split("."))
    known = spark.catalog.tableExists(name)
    if known and [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        if known:
            spark.sql(f"DROP TABLE {quoted}")
        spark.sql(f"CREATE TABLE {quoted} USING {fmt} LOCATION '{path}'")
    versions.publish()
    return rows


def create_namespaces(spark: SparkSession, prefix: str = "", layers: list[str] = LAYERS) -> list[str]:
    """Idempotent schema creation for the four layers."""
    names = [f"{prefix}{layer}" for layer in layers]
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{n}`")
    return names


def append_run_log(counts: DataFrame, target: str) -> int:
    """Create-if-absent and append the run's row counts."""
    return write_counted(counts, target, "append")


def checked(df: DataFrame, schema: StructType, target: str) -> DataFrame:
    """``df`` if its names and types are those of ``schema``."""
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    wanted = [(f.name, f.dataType) for f in schema.fields]
    if actual != wanted:
        raise ValueError(f"schema mismatch for {target}: {actual} != {wanted}")
    return df


def drop_and_rebuild(df: DataFrame, target: str, schema: StructType) -> int:
    """A table rebuilt with an explicit, checked schema (names and types).

    ``target`` is a folder of this run alone (a staged version); for a table by
    itself see :func:`rebuild_versioned`.
    """
    return write_counted(checked(df, schema, target), target, "overwrite")


def rebuild_versioned(df: DataFrame, root: str, table: str, schema: StructType, keep: int = 2) -> int:
    """S13 for the table ``<root>/<table>``: rebuilt in a fresh folder, then switched by one rename."""
    versions = Versions(df.sparkSession, root)
    rows = write_counted(checked(df, schema, table), versions.stage(table), "overwrite")
    versions.publish(keep)
    return rows
