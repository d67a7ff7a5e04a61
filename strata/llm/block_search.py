"""Nearest neighbours by inner product as a block matrix join with certified int8 tiles.

Vectors become tiles of int8 numbers with a scale each. A tile product (whole numbers, exact in float32) times
both scales differs from the true inner product by at most ``sx*sy*(|x|/2 + |y|/2 + d/4)``, where ``|.|`` is the
sum of absolute int8 values and d the dimension. A candidate whose upper bound is below the k-th best lower
bound, or below the k-th exact score so far, cannot be among the k nearest; the others are computed again in
double precision from the original numbers and kept in a heap per query. The result is therefore exact.

Queries are a stated set; query blocks meet groups of candidate tiles on an explicit block key, so a task holds
one query block and one group. The heaps of a query block are merged over the groups in a tree of bounded
fan-in. Nothing is broadcast or collected.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
null ids; vectors meet only those of their dimension; a candidate with the query's id is its own row and left
out; every other row counts as often as it occurs, and a repeated query row gets its result each time; ties go
to the smaller id; fewer than k candidates give fewer rows; columns other than the id and vector are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_arrow, settled


@dataclass(frozen=True)
class Params:
    k: int = 20
    tile: int = 2048
    query_block: int = 4096
    group_rows: int = 8192
    fan_in: int = 32


TILE = "tile long, dim int, n int, ids binary, vectors binary, codes binary, scales binary"


def tiles(vectors: DataFrame, size: int) -> DataFrame:
    """Rows of up to ``size`` usable vectors of one dimension: ids, doubles, int8 codes and scales."""

    def pack(number: int, ids: list[int], v: np.ndarray) -> dict:
        scale = np.maximum(np.abs(v).max(axis=1) / 127, 5e-324)  # the least positive number, where a 127th is none
        codes = np.rint(v / scale[:, None]).astype(np.int8)
        return {"tile": (TaskContext.get().partitionId() << 32) + number, "dim": v.shape[1], "n": len(v), "ids": np.array(ids, "<i8").tobytes(), "vectors": v.astype("<f8").tobytes(), "codes": codes.tobytes(), "scales": scale.astype("<f8").tobytes()}

    def run(batches):
        schema = pa.schema([("tile", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "vectors", "codes", "scales"))])
        number, waiting = 0, {}
        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(float)  # null components become NaN
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                v = values[a:b]
                if ids[i] is None or b == a or not np.isfinite(v).all() or not v.any():
                    continue
                held = waiting.setdefault(b - a, ([], []))
                held[0].append(ids[i])
                held[1].append(v)
                if len(held[0]) == size:
                    yield pa.RecordBatch.from_pylist([pack(number, held[0], np.array(held[1]))], schema)
                    number += 1
                    del waiting[b - a]
        for held in waiting.values():
            yield pa.RecordBatch.from_pylist([pack(number, held[0], np.array(held[1]))], schema)
            number += 1

    return in_arrow(vectors, run, TILE)


class Tile:
    def __init__(self, row: dict):
        n, d = row["n"], row["dim"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(n, d)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(n, d).astype(np.float32)
        self.scales = np.frombuffer(row["scales"], "<f8")
        self.sums = np.abs(self.codes).sum(axis=1, dtype=float)

    def rows(self, lo: int, hi: int) -> "Tile":
        part = object.__new__(Tile)
        for name, value in vars(self).items():
            setattr(part, name, value[lo:hi])
        return part


def survivors(q: Tile, c: Tile, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that may be among the k nearest; known: the k-th exact score so far, or -inf."""
    d = q.codes.shape[1]
    product = np.zeros((len(q.ids), len(c.ids)))
    for at in range(0, d, 1024):  # sums of 1,024 products of int8 numbers are exact in float32
        product += q.codes[:, at : at + 1024] @ c.codes[:, at : at + 1024].T
    scale = q.scales[:, None] * c.scales[None, :]
    error = scale * ((q.sums[:, None] + c.sums[None, :]) / 2 + d / 4)
    product *= scale
    error += 1e-9 * (np.abs(product) + error) + 1e-300  # rounding of this arithmetic, also near zero, and of the double sums
    lower, upper = product - error, product + error
    beyond = ~(np.isfinite(lower) & np.isfinite(upper))  # no bound holds: such pairs are recomputed
    lower[beyond], upper[beyond] = -np.inf, np.inf
    own = np.zeros(product.shape, bool)
    for j in np.nonzero(np.isin(c.ids, q.ids))[0]:
        own[q.ids == c.ids[j], j] = True
    lower[own] = -np.inf
    if lower.shape[1] >= k:
        known = np.maximum(known, -np.partition(-lower, k - 1, axis=1)[:, k - 1])
    return np.nonzero((upper >= known[:, None]) & ~own)


def search(vectors: DataFrame, is_query: Column, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of every row for which ``is_query`` holds."""
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    chosen = usable.where(is_query)
    count = chosen.count()
    blocks = max(1, -(-count // p.query_block))
    queries = settled(tiles(chosen.repartition(blocks), p.query_block))
    candidates = settled(tiles(usable, p.tile))
    total = candidates.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // p.group_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("block", F.shiftright("tile", 32).cast("int")).withColumn("g", every(groups))
    right = candidates.withColumn("g", F.pmod(F.xxhash64("tile"), F.lit(groups).cast("long")).cast("int")).withColumn("block", every(blocks))

    def tile_products(key: tuple[pa.Scalar, ...], query: pa.Table, tiles_: pa.Table) -> pa.Table:
        out = []
        for row in query.to_pylist():
            q, heaps = Tile(row), [[] for _ in range(row["n"])]
            for other in tiles_.sort_by("tile").to_pylist():
                if other["dim"] == row["dim"]:
                    meet(q, Tile(other), heaps)
            out.append(as_table(row["tile"], key[1].as_py(), row["ids"], [sorted(h, reverse=True) for h in heaps]))
        return pa.concat_tables(out) if out else as_table(0, 0, b"", [])[:0]

    def meet(q: Tile, c: Tile, heaps: list[list[tuple[float, int]]]) -> None:
        for lo in range(0, len(q.ids), 512):
            part = q.rows(lo, lo + 512)
            known = np.array([h[0][0] if len(h) == p.k else -np.inf for h in heaps[lo : lo + 512]])
            a, b = survivors(part, c, known, p.k)
            exact = np.vecdot(part.vectors[a], c.vectors[b])  # as `@` on two vectors, bit for bit
            for x, s, i in zip((a + lo).tolist(), exact.tolist(), c.ids[b].tolist(), strict=True):
                h = heaps[x]
                if s != s:  # infinities of both signs: no product to rank
                    continue
                if len(h) < p.k:
                    heapq.heappush(h, (s, -i))
                elif (s, -i) > h[0]:
                    heapq.heapreplace(h, (s, -i))

    def as_table(tile: int, g: int, ids: bytes, lists: list[list[tuple[float, int]]]) -> pa.Table:
        flat = [x for h in lists for x in h]
        return pa.table({
            "tile": pa.array([tile], pa.int64()), "g": pa.array([g], pa.int32()), "queries": pa.array([ids], pa.binary()),
            "sizes": pa.array([np.array([len(h) for h in lists], "<i4").tobytes()], pa.binary()),
            "scores": pa.array([np.array([s for s, _ in flat], "<f8").tobytes()], pa.binary()),
            "found": pa.array([np.array([-i for _, i in flat], "<i8").tobytes()], pa.binary()),
        })

    def lists_of(row: dict) -> list[list[tuple[float, int]]]:
        scores, found = np.frombuffer(row["scores"], "<f8").tolist(), np.frombuffer(row["found"], "<i8").tolist()
        at, out = 0, []
        for n in np.frombuffer(row["sizes"], "<i4").tolist():
            out.append([(s, -i) for s, i in zip(scores[at : at + n], found[at : at + n], strict=True)])
            at += n
        return out

    def heap_merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = [r for r in table.sort_by("g").to_pylist() if r["queries"]]
        lists = [lists_of(r) for r in rows]
        best = [[x for x, _ in zip(heapq.merge(*same, reverse=True), range(p.k))] for same in zip(*lists, strict=True)]
        return as_table(key[0].as_py(), key[1].as_py(), rows[0]["queries"] if rows else b"", best)

    schema = "tile long, g int, queries binary, sizes binary, scores binary, found binary"
    heaps = left.groupBy("block", "g").cogroup(right.groupBy("block", "g")).applyInArrow(tile_products, schema)
    while groups > 1:
        groups = -(-groups // p.fan_in)
        heaps = heaps.withColumn("g", F.floor(F.col("g") / p.fan_in).cast("int")).groupBy("tile", "g").applyInArrow(heap_merge, schema)

    def listed(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lists = lists_of(row)
                ids = np.repeat(np.frombuffer(row["queries"], "<i8"), [len(h) for h in lists])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.concatenate([np.arange(1, len(h) + 1) for h in lists]).astype(np.int32) if lists else np.zeros(0, np.int32)), pa.array(np.frombuffer(row["found"], "<i8")), pa.array(np.frombuffer(row["scores"], "<f8"))],
                    names=["query_id", "rank", "vec_id", "score"],
                )

    return in_arrow(heaps, listed, "query_id long, rank int, vec_id long, score double")
