"""The ledger of a landing: which run brought which files, with which columns.

Every landing of an entity is a *run* on a load date. Its rows lie in a folder of its own,
``load_date=<d>/run_id=<r>``, and one small file in ``_ledger`` says so when they are all there: dates, run,
folders, files and schema. Readers take folders and columns from the ledger, so they list no data folder, open
no footer to learn a schema, and see nothing of a run that died. A retry of a run gets a fresh folder and
takes the place of that run alone. The ledger's files are numbered, and a stream over them is a stream of runs.

Landings from before there was a ledger (with and without run folders) are entered by :meth:`Ledger.adopt`, which
the first landing after that does by itself.

The ledger is bounded by the number of runs; rows of the data never pass through the driver. One writer per
landing is assumed; a second one at the same moment fails on the number.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from strata.sources.store import Store

LOAD_DATE, RUN_ID = "load_date", "run_id"
FOLDER = "_ledger"
DEFAULT_RUN = "r0"  # the run of a date that is landed without naming one
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
SCHEMA = "number long, parts array<struct<load_date: string, run_id: string, folder: string, files: array<string>, schema: string>>"


class SchemaConflict(ValueError):
    """Two runs have a column of one name and different types."""


@dataclass(frozen=True)
class Part:
    """What a run landed on one date; without a run where the files lie in the date's folder itself."""

    number: int
    load_date: str
    run_id: str | None
    folder: str
    files: tuple[str, ...]
    schema: str

    @property
    def batch(self) -> str:
        named = self.run_id not in (None, DEFAULT_RUN)
        return f"{LOAD_DATE}={self.load_date}" + (f"/{RUN_ID}={self.run_id}" if named else "")


def united(parts: list[Part]) -> StructType:
    """The columns of all parts by name, in the order of their first appearance; other types are reported."""
    fields: dict[str, tuple[StructField, str]] = {}
    for part in parts:
        for f in StructType.fromJson(json.loads(part.schema)).fields:
            known, batch = fields.setdefault(f.name, (f, part.batch))
            if known.dataType != f.dataType:
                raise SchemaConflict(f"column {f.name} is {known.dataType.simpleString()} in {batch} and {f.dataType.simpleString()} in {part.batch}")
    return StructType([StructField(f.name, f.dataType, True) for f, _ in fields.values()])


def batch_column() -> Column:
    """The batch of rows with load_date and run_id: the date, and the run where it has a name."""
    run = F.regexp_replace(RUN_ID, "~[0-9]+$", "")
    date = F.concat(F.lit(f"{LOAD_DATE}="), F.coalesce(F.col(LOAD_DATE).cast("string"), F.lit(NO_DATE)))
    return F.when(F.col(RUN_ID).isNull() | (run == DEFAULT_RUN), date).otherwise(F.concat(date, F.lit(f"/{RUN_ID}="), run))


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, Store(spark, root)
        self.root = self.store.root

    def exists(self) -> bool:
        return bool(self.store.numbers(FOLDER))

    def entries(self) -> list[Part]:
        """Everything ever entered, in order (one small row per run and date)."""
        if not self.exists():
            return []
        rows = self.spark.read.schema(SCHEMA).json(f"{self.root}/{FOLDER}").collect()
        return parts_of(rows)

    def parts(self, entries: list[Part] | None = None) -> list[Part]:
        """What stands: of each run on a date the latest entry, where it has files."""
        latest = {(p.load_date, p.run_id): p for p in (self.entries() if entries is None else entries)}
        return [p for p in sorted(latest.values(), key=lambda p: (p.number, p.load_date)) if p.files]

    def enter(self, number: int, parts: list[Part]) -> None:
        content = [{"load_date": p.load_date, "run_id": p.run_id, "folder": p.folder, "files": list(p.files), "schema": p.schema} for p in parts]
        self.store.publish(FOLDER, number, {"number": number, "parts": content})

    def part(self, number: int, load_date: str, run_id: str | None, folder: str, schema: str) -> Part:
        files = tuple(n for n in self.store.names(folder, False) if n[0] not in "._")
        return Part(number, load_date, run_id, folder, files, schema)

    def found(self) -> list[Part]:
        """The folders that lie here without a ledger; their footers tell the columns."""
        out = []
        for date_folder in self.store.names("", True):
            if not date_folder.startswith(f"{LOAD_DATE}="):
                continue
            inner = [n for n in self.store.names(date_folder, True) if n.startswith(f"{RUN_ID}=")]
            flat = any(n[0] not in "._" for n in self.store.names(date_folder, False))
            for folder, run in [(f"{date_folder}/{n}", n[len(RUN_ID) + 1 :]) for n in inner] + [(date_folder, None)] * flat:
                part = self.part(1, date_folder[len(LOAD_DATE) + 1 :], run, folder, "")
                schema = self.spark.read.option("mergeSchema", True).parquet(*paths(self.root, [part])).schema
                out.append(Part(1, part.load_date, run, folder, part.files, StructType([f for f in schema if f.name not in (LOAD_DATE, RUN_ID)]).json()))
        return out

    def adopt(self) -> None:
        """Enter what was landed before there was a ledger."""
        if not self.exists() and (found := self.found()):
            self.enter(1, found)

    def land(self, df: DataFrame, load_date: str | Column, run_id: str | None = None) -> list[Part]:
        """Write ``df`` as one run, then enter it.

        A run that is landed again, on its date or with a column of dates on all of them, is replaced; other
        runs stay as they are. Without a name each date has one run, and only the dates of ``df`` are replaced.
        """
        run = run_id or DEFAULT_RUN
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
            raise ValueError(f"a run id has letters, digits, '_', '.' and '-': {run!r}")
        self.adopt()
        known = self.entries()
        number = max((p.number for p in known), default=0) + 1
        name = f"{run}~{number}" if any(p.run_id == run for p in known) else run
        one_date = isinstance(load_date, str)
        date = F.lit(load_date).cast("date") if one_date else load_date.cast("date")
        seen = Observation("landed")
        dated = df.withColumns({LOAD_DATE: date, RUN_ID: F.lit(name)}).observe(seen, F.collect_set(F.coalesce(F.col(LOAD_DATE).cast("string"), F.lit(NO_DATE))).alias("dates"))
        (
            dated.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(LOAD_DATE, RUN_ID)
            .parquet(self.root)
        )
        schema = StructType([f for f in df.schema if f.name not in (LOAD_DATE, RUN_ID)]).json()
        dates = sorted(seen.get["dates"] or [])
        parts = [self.part(number, d, run, f"{LOAD_DATE}={d}/{RUN_ID}={name}", schema) for d in dates]
        # what an earlier try of this run landed and this one did not (its date, even without a row) is void
        other = {load_date} if one_date else {p.load_date for p in known if p.run_id == run_id}
        parts += [Part(number, d, run, "", (), schema) for d in sorted(other - set(dates))]
        # files without a run folder are the default run of their date
        if run == DEFAULT_RUN:
            parts += [Part(number, p.load_date, None, "", (), schema) for p in self.parts(known) if p.run_id is None and p.load_date in {q.load_date for q in parts}]
        replaced = {(p.load_date, p.run_id) for p in parts}
        self.enter(number, parts)
        for p in self.parts(known):
            if (p.load_date, p.run_id) in replaced:
                for f in p.files:
                    self.store.delete(f"{p.folder}/{f}")
        return parts


def parts_of(rows) -> list[Part]:
    """Rows of the ledger (``SCHEMA``) as parts, in order."""
    return [
        Part(r["number"], p["load_date"], p["run_id"], p["folder"], tuple(p["files"]), p["schema"])
        for r in sorted(rows, key=lambda r: r["number"]) for p in r["parts"]
    ]


def paths(root: str, parts: list[Part]) -> list[str]:
    """Folders of runs; files one by one where a date's folder may hold runs as well."""
    return [f"{root}/{p.folder}" if p.run_id is not None else f"{root}/{p.folder}/{f}" for p in parts for f in (p.files if p.run_id is None else ("",))]


def read_parts(spark: SparkSession, root: str, parts: list[Part], schema: StructType | None = None) -> DataFrame:
    """The rows of some parts with load_date, run_id (as its folder has it, null without one) and file metadata.

    The columns are those of the ledger, so no file is opened before the query runs.
    """
    columns = united(parts) if schema is None else schema
    full = StructType([*columns.fields, StructField(LOAD_DATE, DateType()), StructField(RUN_ID, StringType())])
    source = F.col("_metadata.file_path").alias("source_file")
    frames = []
    for flat in (False, True):
        some = [p for p in parts if (p.run_id is None) == flat]
        if some:
            known = StructType([f for f in full if f.name != RUN_ID]) if flat else full
            df = spark.read.schema(known).option("basePath", root).parquet(*paths(root, some))
            run = F.lit(None).cast("string").alias(RUN_ID) if flat else F.col(RUN_ID)
            frames.append(df.select(*columns.names, LOAD_DATE, run, source))
    if not frames:
        return spark.createDataFrame([], StructType([*full.fields, StructField("source_file", StringType())]))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
