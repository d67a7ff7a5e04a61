"""Bronze sources (S1-S6): landing files -> raw DataFrames with audit columns.

All readers issue one ``spark.read`` over every selected path (no per-batch
union loop); batch identity comes from the file path or the partition column.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources import ledger

FILE_PATH = "_metadata.file_path"
RUN_ID = ledger.RUN_ID  # a second partition level that tells runs of one date apart


def all_string_schema(columns: list[str]) -> StructType:
    """Explicit Bronze schema: every column a nullable string (no inference)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


# Why a line was set aside (fixed values of this package).
BAD_HEADER, BAD_QUOTES, BAD_COUNT = "header", "quotes", "column count"
_CORRUPT = "_corrupt_record"
# A line whose quotes are in order: fields without any, or quoted as a whole with inner ones doubled or escaped.
_FIELD = r'(?:[ \t]*+"[^"\\]*+(?:(?:""|\\.)[^"\\]*+)*+"[ \t]*+|[^",]*+)'
_QUOTED_LINE = rf"^{_FIELD}(?:,{_FIELD})*+$"
HEAD_BYTES = 1 << 16


def _first_lines(spark: SparkSession, paths: list[str]) -> list[str]:
    """The first line of each file (up to ``HEAD_BYTES``), read side by side on the driver like a listing."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()

    def first(path: str) -> str:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
        stream = at.getFileSystem(conf).open(at)
        try:
            head = bytes(stream.readNBytes(HEAD_BYTES))
        finally:
            stream.close()
        return re.split(r"[\r\n]", head.decode("utf-8", "replace").removeprefix("\ufeff"), maxsplit=1)[0]

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(first, paths))


def _decoded(text: Column) -> Column:
    """Percent signs of a path resolved; a plus sign is itself, and what cannot be resolved stays."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(text, r"\+", "%2B")), text)


def split_csv_lines(lines: DataFrame, columns: list[str], bad_files: DataFrame | None = None, keep: tuple[str, ...] = ("batch_id", "source_file")) -> tuple[DataFrame, DataFrame]:
    """Lines of CSV files (``value`` and the ``keep`` columns) as rows, and the lines that are not rows.

    A line is set aside with its reason when its quotes are not in order or when it has another number of fields
    than ``columns``. Blank lines and header lines are neither. Rejected: ``keep``, raw_line, rejected_reason.
    """
    header = ",".join(columns)
    bare = F.ltrim(F.regexp_replace("value", "^\ufeff", ""))
    body = lines.where((F.trim("value") != "") & (F.regexp_replace(F.trim(bare), '"', "") != header))
    schema = ", ".join(f"`{c}` string" for c in [*columns, _CORRUPT])

    def parse(escape: str) -> Column:
        return F.from_csv("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": escape})

    # inner quotes are doubled, or escaped by a backslash as Spark writes them
    parsed = F.when(F.instr("value", '\\"') > 0, parse("\\")).otherwise(parse('"'))
    in_order = F.when(F.instr("value", '"') == 0, F.lit(True)).otherwise(F.col("value").rlike(_QUOTED_LINE))
    tagged = body.select(*keep, "value", parsed.alias("row"), in_order.alias("in_order"))
    whole = F.col("in_order") & F.col(f"row.{_CORRUPT}").isNull()
    rows = tagged.where(whole).select(*[F.col(f"row.`{c}`").alias(c) for c in columns], *keep)
    reason = F.when(~F.col("in_order"), BAD_QUOTES).otherwise(BAD_COUNT)
    rejected = tagged.where(~whole).select(*keep, F.col("value").alias("raw_line"), reason.alias("rejected_reason"))
    if bad_files is not None:
        rejected = rejected.unionByName(bad_files.where(F.trim("value") != "").select(*keep, F.col("value").alias("raw_line"), F.lit(BAD_HEADER).alias("rejected_reason")))
    return rows, rejected


def _split_csv_files(spark: SparkSession, paths: list[str], columns: list[str], batch: Column) -> tuple[DataFrame, DataFrame]:
    """Each file's header is checked on its own; a file with another header is set aside whole."""
    files = sorted(spark.read.text(paths).inputFiles()) if paths else []
    good, bad = [], []
    for path, head in zip(files, _first_lines(spark, files), strict=True):
        # an empty file has nothing to check; names may be quoted
        (good if head.strip() in ("", ",".join(columns)) or head.strip().replace('"', "") == ",".join(columns) else bad).append(path)

    def lines(some: list[str]) -> DataFrame:
        if not some:
            return spark.createDataFrame([], "value string, batch_id string, source_file string")
        plain = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(p)).toString() for p in some]
        return spark.read.text(plain).select("value", batch.alias("batch_id"), F.col(FILE_PATH).alias("source_file"))

    return split_csv_lines(lines(good), columns, lines(bad) if bad else None)


def split_csv_batches(spark: SparkSession, root: str, batches: list[str], entity: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``<root>/<batch>/<entity>.csv`` of every batch at once, as rows and as lines set aside.

    Rows are all strings with ``batch_id`` and ``source_file``. No line stops the load: ragged, over-long and
    badly quoted lines, and every line of a file whose header is not ``columns`` in their order (trap T5: nothing
    is loaded by position), come back with batch, file and reason. A header-only file contributes nothing.
    """
    paths = [f"{root.rstrip('/')}/{b}/{entity}.csv" for b in batches]
    return _split_csv_files(spark, paths, columns, F.regexp_extract(_decoded(F.col(FILE_PATH)), rf"/([^/]+)/{re.escape(entity)}\.csv(/[^/]*)?$", 1))


def read_csv_batches(spark: SparkSession, root: str, batches: list[str], entity: str, columns: list[str]) -> DataFrame:
    """The rows of :func:`split_csv_batches`."""
    return split_csv_batches(spark, root, batches, entity, columns)[0]


def list_batches(spark: SparkSession, root: str, column: str = "load_date") -> list[str]:
    """Sorted partition values under ``root``; raises when the entity or
    its partitions are missing.  Lists one folder level through the Hadoop file
    system: neither data nor footers are read, and no file list reaches the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        raise FileNotFoundError(f"nothing has been landed in {root}")
    prefix = f"{column}="
    names = (s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
    values = sorted(n[len(prefix):] for n in names if n.startswith(prefix))
    if not values:
        raise FileNotFoundError(f"{root} has no folder named {prefix}<value>")
    return values


def read_partitions(spark: SparkSession, root: str, column: str = "load_date", merge_schema: bool = True) -> DataFrame:
    """Every partition of an incremental entity, merged by column name
    (columns absent from older files become NULL).

    ``batch_id`` is ``'<column>=<value>'``, with ``'/run_id=<run>'`` where the
    run of the date has a name, and ``source_file`` the file path.  A landing
    with a ledger is read by it: folders and columns are known, a column with
    two types is reported.  Without one, dates with and without run folders
    are read together and footers are merged.
    """
    if column != ledger.LOAD_DATE:
        return _with_batch(spark.read.option("mergeSchema", merge_schema).parquet(root), column)
    known = ledger.Ledger(spark, root)
    parts = known.parts() if known.exists() else known.found()
    if not parts:
        raise FileNotFoundError(f"nothing has been landed in {root}")
    return _with_run(ledger.read_parts(spark, known.root, parts))


def _with_run(df: DataFrame) -> DataFrame:
    columns = [c for c in df.columns if c not in (ledger.LOAD_DATE, RUN_ID, "source_file")]
    return df.select(*columns, ledger.LOAD_DATE, ledger.batch_column().alias("batch_id"), "source_file")


def _with_batch(df: DataFrame, column: str) -> DataFrame:
    data_cols = [c for c in df.columns if c not in (column, RUN_ID)]
    return df.select(
        *data_cols,
        F.col(column),
        F.concat(F.lit(f"{column}="), F.col(column).cast("string")).alias("batch_id"),
        F.col(FILE_PATH).alias("source_file"),
    )


def read_latest_snapshot(
    spark: SparkSession, root: str, column: str = "load_date", merge_schema: bool = True
) -> DataFrame:
    """S3: only the greatest partition of a full-load entity; of several runs
    on that date the one landed last.

    The ledger, or else the folder listing, tells which it is, and only that
    folder is opened, so a column that older snapshots had does not come back.
    """
    known = ledger.Ledger(spark, root)
    if column == ledger.LOAD_DATE and known.exists():
        parts = [p for p in known.parts() if p.load_date != ledger.NO_DATE]
        if not parts:
            raise FileNotFoundError(f"nothing has been landed in {root}")
        date = max(p.load_date for p in parts)
        return _with_run(ledger.read_parts(spark, known.root, [[p for p in parts if p.load_date == date][-1]]))
    latest = list_batches(spark, root, column)[-1]
    reader = spark.read.option("mergeSchema", merge_schema).option("basePath", root)
    return _with_batch(reader.parquet(f"{root.rstrip('/')}/{column}={latest}"), column)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A layer table by catalog name, or a folder of files by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def add_bronze_audit(
    df: DataFrame,
    source_system: str,
    batch_id: str | Column | None = None,
    ingestion_ts: Column | None = None,
) -> DataFrame:
    """``batch_id`` (unless present), ``ingestion_timestamp``, ``source_system``.

    ``ingestion_ts`` defaults to ``current_timestamp()``; pass a literal to make
    the output reproducible.
    """
    cols: dict[str, Column] = {}
    if batch_id is not None:
        cols["batch_id"] = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    cols["ingestion_timestamp"] = ingestion_ts if ingestion_ts is not None else F.current_timestamp()
    cols["source_system"] = F.lit(source_system)
    return df.withColumns(cols)


def split_csv_partitioned(spark: SparkSession, root: str, columns: list[str], batch_col: str = "batch_id") -> tuple[DataFrame, DataFrame]:
    """S1 variant for a ``<root>/<batch_col>=<batch>/*.csv`` landing; the batch is the folder's value, as a string."""
    name = F.regexp_extract(F.col(FILE_PATH), rf"/{re.escape(batch_col)}=([^/]*)/[^/]*$", 1)
    batch = F.when(name != "__HIVE_DEFAULT_PARTITION__", _decoded(_decoded(name)))
    rows, rejected = _split_csv_files(spark, [root], columns, batch)
    return rows.withColumnRenamed("batch_id", batch_col), rejected.withColumnRenamed("batch_id", batch_col)


def read_csv_partitioned(spark: SparkSession, root: str, columns: list[str], batch_col: str = "batch_id") -> DataFrame:
    """The rows of :func:`split_csv_partitioned`."""
    return split_csv_partitioned(spark, root, columns, batch_col)[0]
