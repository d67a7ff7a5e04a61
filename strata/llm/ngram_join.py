"""N-gram Jaccard join: MinHash banding, then every candidate pair verified on full n-gram sets.

Texts with one set of word n-grams form a *class* (128-bit fingerprint of the set), so copies are joined
once. Classes get ``bands * rows`` min-hashes; ``banding`` picks the counts for the target recall at the
similarity. After the shuffle on band hashes, each bucket is compared in blocks of ``block`` members (a hot
bucket becomes several block pairs, each its own group), on min-hash signatures with a margin of four
standard errors, and only a spanning forest of the pairs found leaves the task. Its components are sets of
likely partners; their full n-gram sets are fetched and *all* pairs inside whose sizes allow the similarity are
verified exactly, again in blocks, and range by range of the n-grams' hashes, so that what a task holds does not
depend on the length of texts. Nothing but counts and forests leaves a task, so a group of thousands of near copies costs no
quadratic output, and no link in it is lost.

Words are runs of bytes other than ASCII white space. Defined results: a text of one to ``words - 1`` words
has one n-gram of them all; a null or empty text has none, hence no links and its own class id; repeated rows
are copies of each other; a null id counts as the smallest id where one must be chosen; columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import ceil, log, log1p, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, blocks, column_bytes, hashes, in_arrow, mix, runs, settled
from strata.operators.joins import SALT, hot_keys, spread_null_keys

_WORD = (~SPACE).astype(np.uint8)
_ODD = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


@dataclass(frozen=True)
class Params:
    words: int = 5
    similarity: float = 0.8
    recall: float = 0.999
    max_hashes: int = 128
    block: int = 1024
    bitmap_log2: int = 23
    range_grams: int = 1 << 20


def banding(similarity: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """Most rows a band (fewest false candidates) whose band count for the recall stays within the hashes."""
    best = (1, 1)
    for rows in range(1, max_hashes + 1):
        hit = similarity**rows  # the chance that two such texts share a band
        bands = 1 if hit >= recall else ceil(log1p(-recall) / log1p(-hit))
        if rows == 1 or bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def grams(texts: list[bytes], words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The first index and sorted distinct n-gram hashes of some texts after another, about 2 MB at once."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= 2 << 20):
            size += len(texts[hi])
            hi += 1
        h, d = [], []
        for block in blocks(texts[lo:hi]):
            starts, ends = runs(_WORD[block.buf])
            h.append(hashes(block.buf, starts, ends))
            d.append(block.owner[block.part_of(starts)])
        word, doc = np.concatenate(h), np.concatenate(d)
        bounds = np.searchsorted(doc, np.arange(hi - lo + 1))
        gram = np.zeros(max(0, len(word) - words + 1), np.uint64)
        for k in range(words):
            gram = gram * _ODD[0] + (word[k : len(word) - words + 1 + k] ^ _ODD[1 + k % 4])
        gram = mix(gram)
        out = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= words:
                out.append(np.unique(gram[a : b - words + 1]))
            elif b > a:
                short = np.full(1, b - a, np.uint64)
                for k in range(a, b):
                    short = mix(short * _ODD[2] + word[k : k + 1])
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
        yield lo, out
        lo = hi


def fingerprints(sets: list[np.ndarray]) -> list[bytes | None]:
    """16 bytes that name a set; None for the empty one."""
    some = [s for s in sets if len(s)]
    if not some:
        return [None] * len(sets)
    first = np.concatenate(([0], np.cumsum([len(s) for s in some])[:-1]))
    every = np.concatenate(some)
    lanes = np.column_stack([np.add.reduceat(mix(every ^ _ODD[1]), first), np.add.reduceat(mix(every ^ _ODD[2]), first)]).tobytes()
    names = iter(range(0, len(lanes), 16))
    return [lanes[(k := next(names)) : k + 16] if len(s) else None for s in sets]


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and 16-bit signatures of non-empty sets."""
    rng = np.random.default_rng(11)
    a = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    low = np.empty((len(sets), bands * rows), np.uint32)
    for k in range(bands * rows):
        low[:, k] = np.minimum.reduceat(x * a[k] + b[k], first)
    keys = np.empty((len(sets), bands), np.uint64)
    for j in range(bands):
        h = np.full(len(sets), j + 1, np.uint64)
        for r in range(rows):
            h = mix(h * _ODD[0] + low[:, j * rows + r])
        keys[:, j] = h
    return keys.view(np.int64), mix(low.astype(np.uint64)).astype(np.uint16)


def described(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, cls, size, bands, sig: one row per input row."""
    bands, rows = banding(p.similarity, p.recall, p.max_hashes)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, sets in grams(column_bytes(batch, "text"), p.words):
                names, some = fingerprints(sets), [s for s in sets if len(s)]
                keys, sig = signatures(some, bands, rows) if some else (np.zeros((0, bands), np.int64), np.zeros((0, bands * rows), np.uint16))
                offsets = np.concatenate(([0], np.cumsum([bands * bool(len(s)) for s in sets]))).astype(np.int32)
                packed = iter(sig)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, len(sets)), pa.array(names, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())), pa.array([next(packed).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "cls", "size", "bands", "sig"],
                )

    rows_ = docs.select("doc_id", "text")
    return in_arrow(rows_, run, f"doc_id {rows_.schema['doc_id'].dataType.simpleString()}, cls binary, size long, bands array<long>, sig binary")


def in_blocks(df: DataFrame, key: str, member: str, block: int, bins: int) -> DataFrame:
    """Rows with ``n`` (members of their key) as parts of groups ``gid``: small keys share bins, a key of
    more than ``block`` members is dealt into blocks and each pair of blocks is a group of its own."""
    m = F.ceil(F.col("n") / block).cast("int")
    split = df.withColumn("m", m).withColumn("b", F.pmod(F.xxhash64(member), F.col("m")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("m") - 1),
        lambda j: F.struct(F.least(F.col("b"), j).alias("i"), F.greatest(F.col("b"), j).alias("k"), (F.col("b") > j).alias("far")),
    )
    out = split.withColumn("pair", F.explode(pairs)).select("*", "pair.i", "pair.k", "pair.far").drop("pair", "b", "n")
    own = F.lit(bins).cast("long") + F.pmod(F.xxhash64(key, "i", "k"), F.lit(1 << 40))
    return out.withColumn("gid", F.when(F.col("m") == 1, F.pmod(F.xxhash64(key), F.lit(bins).cast("long"))).otherwise(own)).drop("m")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's component, for edges a-b among n nodes."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def spans(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order by the keys and the bounds of equal ones in it."""
    order = np.lexsort(keys[::-1])
    differs = np.zeros(max(0, len(order) - 1), bool)
    for k in keys:
        differs |= k[order][1:] != k[order][:-1]
    return order, np.concatenate(([0], np.flatnonzero(differs) + 1, [len(order)])) if len(order) else np.zeros(1, np.int64)


def similar_pairs(sig: np.ndarray, far: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the pairs of one bucket (or of two blocks) whose signatures agree enough."""
    cross = far.any()
    left = np.flatnonzero(~far) if cross else np.arange(len(sig))
    right = np.flatnonzero(far) if cross else None
    label, a, b = np.arange(len(sig)), [], []
    for at, x in enumerate(left):
        others = right if cross else left[at + 1 :]
        if not len(others):
            break
        hits = others[(sig[others] == sig[x]).mean(axis=1) >= least]
        new, where = np.unique(label[hits], return_index=True)
        where = where[new != label[x]]
        if len(where):
            a.append(np.full(len(where), x))
            b.append(hits[where])
            label[np.isin(label, np.append(new, label[x]))] = label[x]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def candidate_edges(classes: DataFrame, p: Params) -> DataFrame:
    """a, b: forests of the likely partners found in the band buckets."""
    bands, rows = banding(p.similarity, p.recall, p.max_hashes)
    least = p.similarity - 4 * sqrt(p.similarity * (1 - p.similarity) / (bands * rows))
    members = classes.select("cls", F.explode("bands").alias("key"))
    counts = settled(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    several = members.join(counts, "key").join(classes.select("cls", "sig"), "cls")
    groups = in_blocks(several, "key", "cls", p.block, max(16, total >> 13))

    def run(table: pa.Table) -> pa.Table:
        cls = table["cls"].to_pylist()
        number: dict[bytes, int] = {}
        node = np.array([number.setdefault(c, len(number)) for c in cls], np.int64)
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(cls), -1)
        far = table["far"].to_numpy(zero_copy_only=False)
        order, bounds = spans(table["key"].to_numpy(), table["i"].to_numpy(), table["k"].to_numpy())
        sizes, a, b = np.diff(bounds), [], []
        for first in range(0, max(0, len(sizes)), 4096):  # buckets of two, the most, at once
            two = bounds[:-1][first : first + 4096][sizes[first : first + 4096] == 2]
            x, y = order[two], order[two + 1]
            near = (sig[x] == sig[y]).mean(axis=1) >= least
            a.append(node[x[near]])
            b.append(node[y[near]])
        for k in np.flatnonzero(sizes > 2):
            rows_ = order[bounds[k] : bounds[k + 1]]
            x, y = similar_pairs(sig[rows_], far[rows_], least)
            a.append(node[rows_[x]])
            b.append(node[rows_[y]])
        label = roots(len(number), np.concatenate(a), np.concatenate(b)) if a else np.arange(len(number))
        names = list(number)
        moved = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"a": pa.array([names[x] for x in moved], pa.binary()), "b": pa.array([names[label[x]] for x in moved], pa.binary())})

    return groups.select("gid", "key", "i", "k", "far", "cls", "sig").groupBy("gid").applyInArrow(run, "a binary, b binary")


_HOT = 1 / 64  # a key with this share of the rows, or more, is dealt to many tasks


def hot(rows: DataFrame, key: str) -> DataFrame:
    """The hot keys, 64 at most."""
    return F.broadcast(hot_keys(rows, key, _HOT))


def looked_up(rows: DataFrame, table: DataFrame, key: str, spread: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their key's one row in ``table``; keys in ``spread``, and null, go to many tasks."""
    f, t = spread_null_keys(rows, table.withColumnRenamed(key, "_of"), key, "_of", _HOT, 32, spread)
    return f.join(t, (F.col(key) == F.col("_of")) & (F.col(SALT) == F.col("_v_salt")), how).drop(SALT, "_v_salt", "_of")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable over the edges, for every node that has one.

    Each round takes the least label among neighbours, then follows it one step; rounds grow with the
    logarithm of a component's diameter and are cut by checkpoints. Centres of large stars, and the labels that
    large components have come to, are spread over tasks.
    """
    both = settled(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    centres = hot(both, "b")
    while True:
        heard = looked_up(both, labels.withColumnRenamed("node", "b"), "b", centres).groupBy("a").agg(F.min("root").alias("heard"))
        lower = labels.join(heard, labels["node"] == heard["a"], "left").select("node", "root", F.least("root", F.coalesce("heard", "root")).alias("low"))
        step = labels.select(F.col("node").alias("low"), F.col("root").alias("next"))
        joined = looked_up(lower, step, "low", hot(labels, "root")).select("node", F.col("root").alias("was"), F.least("low", "next").alias("root"))
        joined = settled(joined)
        changed = joined.where("root <> was").limit(1).count()
        labels = joined.select("node", "root")
        if not changed:
            return labels


def bitmap(nodes: DataFrame, log2: int) -> np.ndarray:
    """A fixed-size bit field of the classes' crc32: what it lacks is no candidate."""
    bit = nodes.select(F.pmod(F.crc32("node"), F.lit(1 << log2)).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (log2 - 5), np.uint32)
    if words.num_rows:
        out[words["w"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


def gram_sets(docs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """cls, grams: the n-gram set of each class in ``nodes`` (and few others), once per class."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(nodes, p.bitmap_log2))

    def run(batches):
        sent: set[bytes] = set()
        for batch in batches:
            for _, sets in grams(column_bytes(batch, "text"), p.words):
                names, values = [], []
                for name, s in zip(fingerprints(sets), sets, strict=True):
                    at = zlib.crc32(name) & ((1 << p.bitmap_log2) - 1) if name else 0
                    if name and shared.value[at >> 5] >> np.uint32(at & 31) & 1 and name not in sent:
                        sent.add(name)
                        names.append(name)
                        values.append(s.tobytes())
                if len(sent) > 100_000:
                    sent.clear()  # repeats cost a row, not the result
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(values, pa.binary())], names=["cls", "grams"])

    return in_arrow(docs.select("text"), run, "cls binary, grams binary").groupBy("cls").agg(F.first("grams").alias("grams"))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections. Frequent n-grams by matrix product, the others by their few pairs."""
    every, code = np.unique(np.concatenate(left + right), return_inverse=True)
    at = sum(map(len, left))
    la, ra = np.repeat(np.arange(len(left)), [len(s) for s in left]), np.repeat(np.arange(len(right)), [len(s) for s in right])
    lc, rc = code[:at], code[at:]
    cl, cr = np.bincount(lc, minlength=len(every)), np.bincount(rc, minlength=len(every))
    out = np.zeros((len(left), len(right)))
    heavy = np.flatnonzero(cl * cr > 64)
    column = np.full(len(every), -1)
    column[heavy] = np.arange(len(heavy))
    for first in range(0, len(heavy), 2048):
        a, b = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
        for matrix, owner, c in ((a, la, column[lc] - first), (b, ra, column[rc] - first)):
            inside = (c >= 0) & (c < 2048)
            matrix[owner[inside], c[inside]] = 1
        out += a @ b.T
    light = (cl * cr > 0) & (cl * cr <= 64)
    order = np.argsort(lc, kind="stable")
    begin = np.concatenate(([0], np.cumsum(cl)))
    some = np.flatnonzero(light[rc])
    for rows in np.array_split(some, max(1, len(some) >> 17)):
        times = cl[rc[rows]]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        a = la[order[np.repeat(begin[rc[rows]], times) + inner]]
        out += np.bincount(a * len(right) + np.repeat(ra[rows], times), minlength=out.size).reshape(out.shape)
    return out.astype(np.int64)


def dealt(nodes: DataFrame, p: Params) -> DataFrame:
    """``nodes`` (cls, root, size, copies) with ``targets``: the comparisons that a class takes part in.

    Sizes fall into bands of which only neighbours can reach the similarity. A band of a root is dealt into blocks
    of about ``block / 2`` classes; a comparison (lo, hi, i, k) is block i of band lo against block k of band hi,
    or a block with itself. It goes through the n-grams in ``ranges`` of their hashes, about ``range_grams`` in each.
    """
    width = max(-log(p.similarity), 1e-6) * (1 + 1e-9)  # a little wider, so that rounding loses no neighbour
    nodes = nodes.withColumn("band", F.floor(F.log(F.col("size")) / width))
    nodes = settled(nodes.withColumn("place", F.concat("root", F.lit(":").cast("binary"), F.col("band").cast("string").cast("binary"))))
    bands = nodes.groupBy("root", "band", "place").agg(F.count("*").alias("n"), F.sum("size").alias("grams"))
    bands = bands.withColumn("m", F.ceil(F.col("n") * 2 / p.block).cast("int")).withColumn("held", F.col("grams") / F.col("m"))
    beside = bands.select("root", "band", "place", "n", "m", "held")
    for name, step in (("up", 1), ("down", -1)):
        other = bands.select("root", (F.col("band") - step).alias("band"), F.col("m").alias(f"m_{name}"), F.col("held").alias(f"held_{name}"))
        beside = beside.join(other, ["root", "band"], "left")
    b, m, band = F.pmod(F.xxhash64("cls"), F.col("m")).cast("int"), F.col("m"), F.col("band")

    def targets(there: Column, lo: Column, hi: Column, count: Column, held: Column, place) -> Column:
        ranges = F.ceil((F.col("held") + held) / p.range_grams).cast("int")
        each = lambda j: F.struct(lo.alias("lo"), hi.alias("hi"), *(x.alias(c) for c, x in zip(("i", "k", "far"), place(j), strict=True)), ranges.alias("ranges"))
        # a sequence that ends before it starts would run backwards, so absent neighbours get an empty array
        return F.coalesce(F.when(there, F.transform(F.sequence(F.lit(0), count - 1), each)), F.expr("cast(array() as array<struct<lo:long,hi:long,i:int,k:int,far:boolean,ranges:int>>)"))

    own = targets(F.col("n") > 1, band, band, m, F.col("held"), lambda j: (F.least(b, j), F.greatest(b, j), b > j))
    up = targets(F.col("m_up").isNotNull(), band, band + 1, F.col("m_up"), F.col("held_up"), lambda j: (b, j, F.lit(False)))
    down = targets(F.col("m_down").isNotNull(), band - 1, band, F.col("m_down"), F.col("held_down"), lambda j: (j, b, F.lit(True)))
    return looked_up(nodes, beside.drop("root", "band"), "place", hot(nodes, "place")).select("cls", "root", "size", "copies", F.concat(own, up, down).alias("targets")).where(F.size("targets") > 0)


_TARGET = ("root", "lo", "hi", "i", "k")
_MEMBER = ("at", "far", "cls", "size", "copies", "grams")


def sent(rows: DataFrame, p: Params) -> DataFrame:
    """The classes' n-grams, a row for each comparison and range of hashes; each class has a row in range 0."""
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.binary())

    def run(batches):
        out, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                grams_ = np.frombuffer(row["grams"], np.uint64)
                for t in row["targets"]:
                    n = t["ranges"]
                    borders = np.array([(k << 64) // n for k in range(1, n)], np.uint64)
                    bounds = [0, *np.searchsorted(grams_, borders).tolist(), len(grams_)]
                    for at, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                        if hi > lo or not at:
                            out.append((row["root"], t["lo"], t["hi"], t["i"], t["k"], at, t["far"], row["cls"], row["size"], row["copies"], grams_[lo:hi].tobytes()))
                            held += 8 * (hi - lo) + 100
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*out, strict=True), kinds, strict=True)], names=[*_TARGET, *_MEMBER])
                            out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*out, strict=True), kinds, strict=True)], names=[*_TARGET, *_MEMBER])

    return in_arrow(rows, run, "root binary, lo long, hi long, i int, k int, at int, far boolean, cls binary, size long, copies long, grams binary")


class Comparison:
    """One block of classes with itself, or two with each other: intersections are added up range by range."""

    def __init__(self, itself: bool):
        self.itself, self.at = itself, 0
        self.cls, self.far, self.size, self.copies = [], [], [], []
        self.row: dict[bytes, int] = {}
        self.held: dict[int, np.ndarray] = {}
        self.common = None

    def add(self, at: int, far: bool, cls: bytes, size: int, copies: int, data: bytes) -> None:
        if at != self.at:
            self.add_up()
            self.at = at
        if not at and cls not in self.row:
            self.row[cls] = len(self.cls)
            for column, x in ((self.cls, cls), (self.far, far), (self.size, size), (self.copies, copies)):
                column.append(x)
        self.held[self.row[cls]] = np.frombuffer(data, np.uint64)

    def add_up(self) -> None:
        if self.common is None:  # range 0 names all classes
            far = np.array(self.far)
            self.left, self.right = (np.arange(len(far)),) * 2 if self.itself else (np.flatnonzero(~far), np.flatnonzero(far))
            self.common = np.zeros((len(self.left), len(self.right)), np.int64)
        x, y = ([k for k, row in enumerate(side) if len(self.held.get(row, ()))] for side in (self.left, self.right))
        if x and y:
            self.common[np.ix_(x, y)] += shared_counts([self.held[self.left[k]] for k in x], [self.held[self.right[k]] for k in y])
        self.held = {}

    def links(self, share: Fraction) -> Iterator[tuple[bytes, int, bytes]]:
        """Each linked class, the documents it links to, and the root of its part of the linked ones."""
        self.add_up()
        size, weight = np.array(self.size), np.array(self.copies)
        union = size[self.left][:, None] + size[self.right][None, :] - self.common
        linked = self.common * share.denominator >= union * share.numerator
        if self.itself:
            np.fill_diagonal(linked, False)
        count = np.zeros(len(size), np.int64)
        count[self.left] += linked @ weight[self.right]
        if not self.itself:
            count[self.right] += weight[self.left] @ linked
        a, b = np.nonzero(linked)
        label = roots(len(size), self.left[a], self.right[b])
        for x in np.flatnonzero(count).tolist():
            yield self.cls[x], int(count[x]), self.cls[label[x]]


def verified(sets: DataFrame, groups: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """cls, links, peer: links of a class found in one comparison (documents) and its root in that forest.

    A task streams through its comparisons in order and holds one range of one comparison, whatever the texts' lengths.
    """
    share = Fraction(str(p.similarity))
    nodes = groups.join(classes, groups["node"] == classes["cls"]).select("cls", "root", "size", "copies")
    rows = sets.join(dealt(nodes, p), "cls").select("cls", "root", "size", "copies", "grams", "targets")

    def run(batches):
        now = work = None
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in (*_TARGET, *_MEMBER)), strict=True):
                if row[:5] != now:
                    out += work.links(share) if work else ()
                    now, work = row[:5], Comparison(row[1] == row[2] and row[3] == row[4])
                work.add(*row[5:])
            yield found(out)
        if work:
            yield found(list(work.links(share)))

    def found(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], names=["cls", "links", "peer"])

    streamed = sent(rows, p).repartition(*_TARGET).sortWithinPartitions(*_TARGET, "at")
    return in_arrow(streamed, run, "cls binary, links long, peer binary")


def classes_of(docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """(doc_id, cls) of every row, and per class: copies, text_class, links, group, class_id.

    ``text_class`` is the least id of the class, ``class_id`` that of its connected group.
    """
    rows = settled(described(docs, p))
    classes = settled(rows.where("cls is not null").groupBy("cls").agg(F.count("*").alias("copies"), F.min("doc_id").alias("text_class"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    likely = components(candidate_edges(classes, p))
    found = settled(verified(gram_sets(docs, likely, p), likely, classes.select("cls", "size", "copies"), p))
    groups = components(found.where("cls <> peer").select(F.col("cls").alias("a"), F.col("peer").alias("b")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    table = (
        classes.select("cls", "copies", "text_class")
        .join(links, "cls", "left")
        .join(groups.select(F.col("node").alias("cls"), "root"), "cls", "left")
        .select("cls", "copies", "text_class", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cls").alias("group"))
    )
    ids = table.groupBy("group").agg(F.min("text_class").alias("class_id"))
    return rows.select("doc_id", "cls"), looked_up(table, ids, "group", hot(groups, "root"))


def join(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, class_id, text_class, n_links: one row per input row.

    ``n_links`` counts the other rows whose n-gram sets reach the similarity, copies included.
    """
    rows, table = classes_of(docs, p)
    return looked_up(rows, table, "cls", hot(rows, "cls"), "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("text_class", "doc_id").alias("text_class"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, all columns, less all but one of each connected group: the least id stays.

    Rows without words stay. Among rows of one id, the least set fingerprint stays, and of repeats one.
    """
    rows, table = classes_of(docs, p)
    key = lambda name: F.concat(F.col(name), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "cls")).alias("least")
    keep = looked_up(rows, table.select("cls", "group"), "cls", hot(rows, "cls")).groupBy("group").agg(least).select("least.*").select(key("cls").alias("_key"), F.lit(True).alias("_keep"))
    names = docs.columns
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)), "doc_id", "text")
    schema = plain.drop("text").schema.add("_cls", "binary")

    def run(batches):
        for batch in batches:
            rest = batch.drop_columns(["text"])
            for lo, sets in grams(column_bytes(batch, "text"), p.words):
                yield rest.slice(lo, len(sets)).append_column("_cls", pa.array(fingerprints(sets), pa.binary()))

    marked = in_arrow(plain, run, schema).withColumn(
        "_key", F.coalesce(key("_cls"), F.concat(F.lit("empty "), F.monotonically_increasing_id().cast("string")).cast("binary"))
    )
    kept = looked_up(marked, keep, "_key", hot(rows.select(key("cls").alias("_key")), "_key"), "left").where("_keep or _cls is null").dropDuplicates(["_key"])
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names)))
