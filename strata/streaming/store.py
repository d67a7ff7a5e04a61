"""A Type-2 history that is changed where it changes: buckets of keys, closed versions apart.

Keys are dealt to ``buckets`` by hash. Of each bucket there are the current versions (one folder), the closed ones
(folders that are only added to), and the rows applied so far (the same); beside them lies the order of all
batches, a row each. An epoch reads and rewrites the current versions of the buckets that its rows touch, adds the
versions that it closed and the rows that it applied, and leaves every other folder as it is.

A *late* batch sorts before one applied already. The order of batches tells so without a look at the landing; the
buckets of its keys are built anew from the rows applied, which are kept for that.

What belongs to the history is named by one numbered file per epoch (see :mod:`strata.sources.store`): an epoch is
seen whole or not at all, one that is run again after a crash starts from the same state, and one that has been
published is not applied twice. Folders that the last ``keep`` epochs do not name are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators import history as H
from strata.sources.store import Store

POINTERS = "_versions"
BUCKET, STATE = "bucket", "state"
KINDS = ("current", "closed", "feed")
EMPTY = {"epoch": -1, "current": {}, "closed": {}, "feed": {}, "batches": None, "schemas": {}}


class HistoryStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str = "customer_id",
        ts_col: str = "updated_at",
        tracked: list[str] = H.CUSTOMER_TRACKED,
        sk_col: str = "customer_sk",
        buckets: int = 64,
        folders: int = 16,
    ):
        """``buckets`` holds for the life of the store; a bucket with ``folders`` folders of a kind gets one again."""
        self.spark, self.files, self.buckets, self.folders = spark, Store(spark, root), buckets, folders
        self.root, self.key, self.ts_col, self.tracked, self.sk_col = self.files.root, key, ts_col, tracked, sk_col
        numbers = self.files.numbers(POINTERS)
        self.state = self.files.content(POINTERS, numbers[-1]) if numbers else dict(EMPTY)
        if numbers and self.state["buckets"] != buckets:
            raise ValueError(f"{root} has {self.state['buckets']} buckets, not {buckets}")

    @property
    def epoch(self) -> int:
        return self.state["epoch"]

    # -- reading ---------------------------------------------------------------------------------------------
    def _read(self, kind: str, paths: list[str]) -> DataFrame | None:
        """Some folders of a kind, with the columns that were written (no footer is opened to learn them)."""
        if not paths:
            return None
        schema = StructType.fromJson(self.state["schemas"]["feed" if kind == "feed" else "versions"])
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def paths(self, kind: str, buckets: list[int] | None = None) -> list[str]:
        wanted = self.state[kind].items() if buckets is None else ((str(b), self.state[kind].get(str(b), [])) for b in buckets)
        return [p for _, folders in wanted for p in folders]

    def history(self) -> DataFrame | None:
        """All versions, current and closed."""
        return self._read("versions", self.paths("current") + self.paths("closed"))

    def batch_order(self) -> DataFrame | None:
        if not self.state["batches"]:
            return None
        schema = StructType([StructField("batch_id", StringType()), StructField(H.BATCH_TS, StructType.fromJson(self.state["schemas"]["feed"])[self.ts_col].dataType)])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{self.state['batches']}")

    def has_batches(self, names: list[str]) -> bool:
        order = self.batch_order()
        return order is not None and not order.where(F.col("batch_id").isin(names)).isEmpty()

    # -- writing ---------------------------------------------------------------------------------------------
    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, folder: str, by: list[str]) -> None:
        (
            df.repartition(*by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*by)
            .parquet(f"{self.root}/{folder}")
        )

    def _written(self, folder: str, buckets: list[int]) -> dict[str, list[str]]:
        there = set(self.files.names(folder, True))
        return {str(b): [f"{folder}/{BUCKET}={b}"] for b in buckets if f"{BUCKET}={b}" in there}

    def apply(self, feed: DataFrame, epoch: int, fresh: bool = False, keep: int = 2) -> None:
        """One epoch: the rows of any number of new batches (a valid, typed feed with ``batch_id``).

        ``fresh`` builds the history from this feed alone.
        """
        if epoch < self.epoch:
            raise RuntimeError(f"{self.root} holds epoch {self.epoch}, later than this stream's {epoch}: go on with the checkpoint that wrote it, or use another folder")
        if epoch == self.epoch:
            return  # published before a crash of the stream
        key, ts = self.key, self.ts_col
        columns = [key, ts, "batch_id", *self.tracked]
        rows = feed.select(*columns).withColumn(BUCKET, self._bucket())
        # one small row per batch: its place in the order and the buckets that it touches
        seen = rows.groupBy("batch_id").agg(F.min(ts).alias(H.BATCH_TS), F.collect_set(BUCKET).alias("touched")).collect()
        order = self.spark.createDataFrame([(r["batch_id"], r[H.BATCH_TS]) for r in seen], StructType([StructField("batch_id", StringType()), StructField(H.BATCH_TS, feed.schema[ts].dataType)]))
        old = None if fresh else self.batch_order()
        last = None if old is None else old.agg(F.max(F.struct(H.BATCH_TS, "batch_id")).alias("last")).first()["last"]
        late = sorted({b for r in seen if last is not None and (r[H.BATCH_TS], r["batch_id"]) <= tuple(last) for b in r["touched"]})
        touched = sorted({b for r in seen for b in r["touched"]})
        state = {k: {} if fresh else dict(self.state[k]) for k in KINDS}
        base = f"e{epoch:012d}"

        # the rows applied, the latest of each key and batch; a bucket of many folders is written as one
        applied = H.dedup_within_batch(rows, key, ts, "batch_id")
        grown = [b for b in touched if len(state["feed"].get(str(b), [])) >= self.folders]
        before = self._read("feed", [p for b in grown for p in state["feed"][str(b)]])
        if before is not None:
            applied = applied.unionByName(before.withColumn(BUCKET, self._bucket()))
        schemas = {"feed": rows.drop(BUCKET).schema.jsonValue()}
        self._write(applied, f"feed/{base}", [BUCKET])
        new_feed = self._written(f"feed/{base}", touched)
        for b, folders in new_feed.items():
            state["feed"][b] = folders if int(b) in grown else state["feed"].get(b, []) + folders
        batches = f"batches/{base}"
        # a row per batch ever applied
        every = order if old is None else old.unionByName(order)
        every.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{batches}")
        schemas["versions"] = self._versions_schema(rows)
        self.state = {**self.state, "schemas": {**self.state["schemas"], **schemas}}

        # late buckets from all rows applied; the others from their current versions and the new rows
        parts = []
        if late:
            all_rows = self._read("feed", [p for b in late for p in state["feed"][str(b)]])
            parts.append(H.build_history(all_rows, key, ts, "batch_id", self.tracked, self.sk_col, order=every))
        rest = [b for b in touched if b not in late]
        if rest:
            new = rows.where(F.col(BUCKET).isin(rest)).drop(BUCKET)
            current = self._read("versions", [p for b in rest for p in state["current"].get(str(b), [])])
            args = (key, ts, "batch_id", self.tracked, self.sk_col)
            parts.append(H.build_history(new, *args, order=order) if current is None else H.apply_batches(current, new, None, *args, order=order))
        crowded = [b for b in rest if len(state["closed"].get(str(b), [])) >= self.folders]
        before = self._read("versions", [p for b in crowded for p in state["closed"][str(b)]])
        if before is not None:
            parts.append(before)
        if parts:
            versions = parts[0]
            for p in parts[1:]:
                versions = versions.unionByName(p)
            labelled = versions.withColumns({STATE: F.when(F.col(H.CURRENT), "current").otherwise("closed"), BUCKET: self._bucket()})
            self._write(labelled, f"versions/{base}", [STATE, BUCKET])
            for kind in ("current", "closed"):
                found = self._written(f"versions/{base}/{STATE}={kind}", touched)
                for b in touched:
                    replaced = kind == "current" or b in late or b in crowded
                    state[kind][str(b)] = ([] if replaced else state[kind].get(str(b), [])) + found.get(str(b), [])
        self.state = {**self.state, **state, "epoch": epoch, "batches": batches, "buckets": self.buckets}
        self.files.publish(POINTERS, epoch + 1, self.state)
        self._prune(keep)

    def _versions_schema(self, rows: DataFrame) -> dict:
        return H.build_history(rows.drop(BUCKET).limit(0), self.key, self.ts_col, "batch_id", self.tracked, self.sk_col).schema.jsonValue()

    def _prune(self, keep: int) -> None:
        """Remove the folders that only epochs before the last ``keep`` name."""
        numbers = self.files.numbers(POINTERS)

        def named(number: int) -> set[str]:
            state = self.files.content(POINTERS, number)
            return {p for kind in KINDS for folders in state[kind].values() for p in folders} | {state["batches"]}

        used = {p for n in numbers[-keep:] for p in named(n)}
        for n in numbers[:-keep]:
            for path in sorted(named(n) - used):
                self.files.delete(path)
            self.files.delete(self.files.numbered(POINTERS, n))
