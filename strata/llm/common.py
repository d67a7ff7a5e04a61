"""Helpers shared by the training-data operators: tables, lineage cuts, labels, text blocks.

Words are maximal runs of bytes other than the six ASCII white-space bytes; all numpy work runs on
UTF-8 bytes in blocks of bounded size, so that a very long text never sits in one array.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, scratch_path

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_GAP = re.compile(rb"[\x20\x09-\x0d]")

#: Byte classes: 0 white space, 1 letter or part of a non-ASCII character, 2 digit, 3 other.
KIND = np.full(256, 3, np.uint8)
KIND[SPACE] = 0
KIND[48:58] = 2
KIND[65:91] = KIND[97:123] = KIND[128:] = 1

_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through the shared folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, data = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}/strata.zip")
    out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(path.toString())
    _shipped.add(sc.applicationId)


_memory: dict[str, object] = {}


def remembered(name: str, make: Callable):
    """An object that a worker process keeps from task to task, made at its first use; one at a time."""
    if name not in _memory:
        _memory.clear()
        _memory[name] = make()
    return _memory[name]


def forget_others(name: str) -> None:
    if name not in _memory:
        _memory.clear()


def in_arrow(df: DataFrame, run: Callable, schema, rows: int = 1000, keeps: str = "") -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors.

    ``run`` gets the batches in slices of at most ``rows`` rows, which bounds what it holds as Python objects.
    ``keeps`` names the worker's memory that it uses; a memory of other work is given up before it starts.
    """
    ship(df.sparkSession)

    def sliced(batches):
        forget_others(keeps)
        return run(b.slice(lo, rows) for b in batches for lo in range(0, b.num_rows, rows))

    return df.mapInArrow(sliced, schema)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: computed once, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; the remainder of a null id is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))


def labelled_sample(labels: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` rows (doc_id, y, part) to learn from, chosen by a hash of the id.

    Null ids and labels are left out, and so are ids whose crc32 remainder is 0 (held out). An id with
    several labels gets their majority, a tie counts as 1. The bound makes the rows safe to broadcast.
    """
    per_id = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (fold() != 0))
        .groupBy("doc_id")
        .agg((F.avg(column) >= 0.5).cast("int").alias("y"))
    )
    return per_id.withColumn("part", fold().cast("int")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sampled_texts(docs: DataFrame, sample: DataFrame, max_bytes: int = 1 << 62) -> DataFrame:
    """doc_id, y, text: one row for each id of a ``labelled_sample`` that has a text, the first of them in its order.

    An id is taken while the texts before it hold less than ``max_bytes``; of several texts of an id the one
    with the smallest hash counts, and null is empty. Only ids, labels, hashes and sizes reach the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    sizes = (
        rows.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min_by(F.octet_length("text"), "hash").alias("size"), F.min("hash").alias("hash"))
        .select("doc_id", "y", "hash", "size", F.xxhash64("doc_id").alias("place"))
    )
    taken, held = [], 0
    for r in sorted(sizes.toArrow().to_pylist(), key=lambda r: (r["place"], r["doc_id"])):
        if held >= max_bytes:
            break
        held += r["size"]
        taken.append((r["doc_id"], r["y"], r["hash"]))
    chosen = F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id long, y int, hash long"))
    return rows.join(chosen, ["doc_id", "hash"]).groupBy("doc_id", "y").agg(F.first("text").alias("text"))


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [b"" if x is None else x for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def cut(data: bytes, limit: int) -> Iterator[bytes]:
    """``data`` in pieces of about ``limit`` bytes, cut only before white space."""
    at = 0
    while len(data) - at > limit:
        end = max(data.rfind(b" ", at + 1, at + limit), data.rfind(b"\n", at + 1, at + limit))
        if end < 0:
            found = _GAP.search(data, at + limit)
            if not found:
                break
            end = found.start()
        yield data[at:end]
        at = end
    yield data[at:]


class Block:
    """Some whole texts, or pieces of one, as one byte array with a line feed after each."""

    def __init__(self, parts: list[tuple[int, bytes]]):
        self.owner = np.array([i for i, _ in parts], np.int64)
        self.buf = np.frombuffer(b"\n".join([x for _, x in parts]) + b"\n", np.uint8)
        self.starts = np.concatenate(([0], np.cumsum([len(x) + 1 for _, x in parts])))[:-1]

    def part_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


def blocks(texts: list[bytes], limit: int = 1 << 19, pieces: bool = True) -> Iterator[Block]:
    """The texts in blocks of about ``limit`` bytes; with ``pieces`` longer texts are cut."""
    parts: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in cut(text, limit) if pieces else (text,):
            if parts and size + len(piece) > limit:
                yield Block(parts)
                parts, size = [], 0
            parts.append((i, piece))
            size += len(piece) + 1
    if parts:
        yield Block(parts)


def runs(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one non-zero class."""
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, ends = np.concatenate(([0], change)), np.concatenate((change, [len(kind)]))
    keep = kind[starts] != 0
    return starts[keep], ends[keep]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefixes: tuple[int, ...] = ()) -> np.ndarray:
    """A 64-bit hash of the bytes of each range, the same wherever the range lies.

    With ``prefixes`` one more column for each length: the hash of so many first bytes, or 0 where the range
    is no longer than that.
    """
    n = len(buf)
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=sums[1:])
    inverse = _powers[1][starts]
    whole = mix((sums[ends] - sums[starts]) * inverse + (ends - starts).astype(np.uint64))
    if not prefixes:
        return whole
    columns = [whole]
    for k in prefixes:
        stop = np.minimum(starts + k, ends)
        columns.append(np.where(stop < ends, mix((sums[stop] - sums[starts]) * inverse + np.uint64(k << 32)), np.uint64(0)))
    return np.column_stack(columns)
