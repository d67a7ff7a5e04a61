"""Context-tree weighting over bytes: the code length of every text under a model of the training texts.

A byte is eight binary decisions. For every context of the last 0 to ``DEPTH`` bytes and every prefix of the
byte's bits, a node counts the zeros and ones that followed in training; its Krichevsky-Trofimov estimate is
``(count + 1/2) / (n + 1)``. A node's weighted probability is half its own estimate of all it saw and half the
product of its children's weighted probabilities, which gives the share ``w`` of its own estimate in a
prediction; the rest comes from the next deeper context. Unseen nodes predict one half.

The text modelled is the words in lower case (A-Z) with one space between, then an end byte (0xFF, never part of
UTF-8); ``DEPTH`` end bytes stand before it. So the probabilities of all texts add up to at most one.

How it is dealt out. Texts are packed into chunks of about ``chunk_bytes``. A chunk asks for the distinct 6-byte
sequences (context and byte) and word hashes it holds, with their training counts; requests are added up per
bucket, in a tree of bounded fan-in. A bucket holds whole subtrees below three context bytes (at most 2**24
entries each, whatever the corpus), so it computes depths 5 to 3 itself and its share of the sums for depth 2;
depths 2 to 0 have at most 2**24 entries in all, are added up in a tree too, and are broadcast. The answers then
go down the tree by which the requests came up, each node getting what it asked for, and each chunk scores its
texts. Only distinct sequences move, and texts once, compressed.

Defined results: a null text is empty and only its end is coded; a null id counts as remainder 0 (training);
repeated rows count and are scored each; columns other than ``doc_id`` and ``text`` are not read. Words are told
apart by 64-bit hashes: among n distinct words the chance that any two meet is below n**2 / 2**64.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log, log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import column_bytes, hashes, in_arrow, mix, runs, settled

DEPTH = 5
END = 255
_WORD = np.ones(256, np.uint8)
_WORD[[32, END]] = 0
_HALF = log(0.5)


@dataclass(frozen=True)
class Params:
    chunk_bytes: int = 24 << 20
    slice_bytes: int = 1 << 20
    fan_in: int = 64
    most_buckets: int = 4096


# -- packed arrays ---------------------------------------------------------------------------------------------
def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, after their count; rising ones as differences."""
    if values.dtype == np.uint64:
        values = np.diff(values, prepend=np.uint64(0))
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True) if raw else b""


def unpacked(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    values = np.frombuffer(raw, kind)
    return np.cumsum(values, dtype=np.uint64) if kind is np.uint64 else values


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    every, number = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, number = every[order], number[order]
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(number, first) if len(first) else number


# -- chunks ----------------------------------------------------------------------------------------------------
class Chunk:
    """Normalised texts one after another, those to learn from first."""

    def __init__(self, payload: bytes, lengths: np.ndarray, train: int):
        self.payload, self.train = payload, train
        self.ends = np.cumsum(lengths + DEPTH)  # end bytes stand before each text; the first after it is its own
        self.starts = self.ends - lengths
        self.border = int(self.starts[train]) if train < len(lengths) else len(payload)

    @staticmethod
    def joined(texts: list[bytes]) -> bytes:
        before = bytes([END]) * DEPTH
        return b"".join([x for t in texts for x in (before, t)]) + bytes([END])

    def slices(self, size: int):
        """(first, last) places, cut before a space or an end byte, so that no word is split."""
        at, n = DEPTH, len(self.payload)
        while at < n:
            stop = n
            if n - at > size:
                stop = max(self.payload.rfind(b" ", at + 1, at + size), self.payload.rfind(b"\xff", at + 1, at + size))
                if stop < 0:
                    found = [x for x in (self.payload.find(b" ", at + size), self.payload.find(b"\xff", at + size)) if x > 0]
                    stop = min(found, default=n)
            yield at, stop
            at = stop

    def part(self, at: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sequences (context, byte) of all places and which of them are coded; word hashes and where they start."""
        buf = np.frombuffer(self.payload, np.uint8)[at - DEPTH : stop]
        wide = buf.astype(np.uint64)
        n = stop - at
        keys = wide[DEPTH:].copy()
        for back in range(1, DEPTH + 1):
            keys |= wide[DEPTH - back : DEPTH - back + n] << np.uint64(8 * (DEPTH + 1 - back))
        coded = np.ones(n, bool)
        lo, hi = np.searchsorted(self.ends, at - DEPTH + 1), np.searchsorted(self.ends, stop)
        pads = (self.ends[lo:hi, None] + np.arange(1, DEPTH)).ravel() - at
        coded[pads[(pads >= 0) & (pads < n)]] = False
        own = buf[DEPTH:]
        starts, ends = runs(_WORD[own])
        return keys, coded, hashes(own, starts, ends), starts

    def sums(self, at: int, stop: int, places: np.ndarray | None, values: np.ndarray) -> tuple[slice, np.ndarray]:
        """The texts that a slice touches and the sums of their values; places: where the values stand."""
        lo, hi = int(np.searchsorted(self.ends, at)), int(np.searchsorted(self.starts, stop))
        a, b = np.clip(self.starts[lo:hi], at, stop) - at, np.clip(self.ends[lo:hi] + 1, at, stop) - at
        if places is not None:
            a, b = np.searchsorted(places, a), np.searchsorted(places, b)
        total = np.concatenate(([0], np.cumsum(values)))
        return slice(lo, hi), total[b] - total[a]


def chunked(docs: DataFrame, held_out: Column, p: Params) -> DataFrame:
    """chunk, ids, lengths, train, payload: the texts of a task, packed."""
    rows = docs.select("doc_id", held_out.alias("held"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        number, size, held, ids, texts = 0, 0, [], [], []

        def pack():
            order = np.argsort(held, kind="stable")
            chosen = [texts[k] for k in order]
            payload = Chunk.joined(chosen)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(TaskContext.get().partitionId() << 24) + number], pa.int64()),
                    pa.array([pa.concat_arrays(ids).take(pa.array(order)).to_pylist()], pa.list_(ids[0].type)),
                    pa.array([np.array([len(t) for t in chosen], "<i8").tobytes()], pa.binary()),
                    pa.array([len(held) - int(sum(held))], pa.int64()),
                    pa.array([len(payload)], pa.int64()),
                    pa.array([pa.compress(payload, "zstd", asbytes=True)], pa.binary()),
                ],
                names=["chunk", "ids", "lengths", "train", "size", "payload"],
            )

        for batch in batches:
            flags = batch.column(1).to_pylist()
            first = 0
            for k, text in enumerate(column_bytes(batch, "text")):
                texts.append(b" ".join(text.lower().split()))
                held.append(bool(flags[k]))
                size += len(texts[-1]) + DEPTH
                if size >= p.chunk_bytes:
                    ids.append(batch.column(0).slice(first, k + 1 - first))
                    yield pack()
                    number, size, held, ids, texts, first = number + 1, 0, [], [], [], k + 1
            ids.append(batch.column(0).slice(first))
        if texts:
            yield pack()

    return in_arrow(rows, run, f"chunk long, ids array<{kind}>, lengths binary, train long, size long, payload binary")


def chunk_of(row: dict) -> Chunk:
    payload = pa.decompress(row["payload"], row["size"], "zstd", asbytes=True)
    return Chunk(payload, np.frombuffer(row["lengths"], "<i8"), row["train"])


def requests(chunks: DataFrame, buckets: int, p: Params) -> DataFrame:
    """kind, bucket, chunk, keys, counts: distinct sequences (g) and words (w) of a chunk, training counts."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = chunk_of(row)
                found = {"g": ([], []), "w": ([], [])}
                for at, stop in c.slices(p.slice_bytes):
                    keys, coded, words, starts = c.part(at, stop)
                    learned = {"g": np.arange(at, stop) < c.border, "w": starts + at < c.border}
                    learned["g"] = learned["g"][coded]
                    for kind, values in (("g", keys[coded]), ("w", words)):
                        for inside, weight in ((learned[kind], 1), (~learned[kind], 0)):
                            if inside.any():
                                k, n = np.unique(values[inside], return_counts=True)
                                found[kind][0].append(k)
                                found[kind][1].append(n * weight)
                        if sum(map(len, found[kind][0])) > 1 << 21:
                            k, n = added(*found[kind])
                            found[kind] = ([k], [n])
                for kind, (keys, counts) in found.items():
                    k, n = added(keys, counts)
                    place = (mix(k >> np.uint64(24)) if kind == "g" else k >> np.uint64(20)) % np.uint64(buckets)
                    order = np.argsort(place, kind="stable")
                    bounds = np.searchsorted(place[order], np.arange(buckets + 1))
                    mine = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * buckets), pa.array(range(buckets), pa.int32()), pa.array([row["chunk"]] * buckets, pa.int64()), pa.array([packed(k[x]) for x in mine], pa.binary()), pa.array([packed(n[x]) for x in mine], pa.binary())],
                        names=["kind", "bucket", "chunk", "keys", "counts"],
                    )

    return in_arrow(chunks, run, "kind string, bucket int, chunk long, keys binary, counts binary")


def merged(asked: DataFrame, groups: int, p: Params) -> list[DataFrame]:
    """kind, bucket, g, keys, counts: a table per level, from one row per group and bucket to one per bucket.

    A row is the sum of the ``fan_in`` rows of the level below whose g, divided by ``fan_in``, is its own.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        k, n = added([unpacked(x, np.uint64) for x in table["keys"].to_pylist()], [unpacked(x, np.int64) for x in table["counts"].to_pylist()])
        return pa.table({"kind": pa.array([key[0].as_py()]), "bucket": pa.array([key[1].as_py()], pa.int32()), "g": pa.array([key[2].as_py()], pa.int64()), "keys": pa.array([packed(k)], pa.binary()), "counts": pa.array([packed(n)], pa.binary())})

    levels, below = [], asked.drop("chunk")
    while True:
        levels.append(settled(below.groupBy("kind", "bucket", "g").applyInArrow(run, "kind string, bucket int, g long, keys binary, counts binary")))
        if groups == 1:
            return levels
        groups = -(-groups // p.fan_in)
        below = levels[-1].withColumn("g", F.floor(F.col("g") / p.fan_in))


def answered(levels: list[DataFrame], known: DataFrame, p: Params) -> DataFrame:
    """kind, bucket, at, keys, vals: ``known`` values handed down the tree by which the requests came up.

    ``levels`` starts with the requests (their own ``at`` and the g of the first level). A row gets the values of
    the keys it asked for and no others, so what moves is what was asked, at any number of groups.
    """

    def answer(key: tuple[pa.Scalar, ...], wanted: pa.Table, have: pa.Table) -> pa.Table:
        kind = np.int64 if key[0].as_py() == "w" else np.float32
        keys, vals = (unpacked(have[c][0].as_py(), t) for c, t in (("keys", np.uint64), ("vals", kind))) if have.num_rows else (np.zeros(0, np.uint64), np.zeros(0, kind))
        found = [packed(vals[np.searchsorted(keys, unpacked(x, np.uint64))]) for x in wanted["keys"].to_pylist()]
        return pa.table({"kind": wanted["kind"], "bucket": wanted["bucket"], "at": wanted["at"], "keys": wanted["keys"], "vals": pa.array(found, pa.binary())})

    wants = [levels[0].select("kind", "bucket", "g", "at", "keys")]
    wants += [level.select("kind", "bucket", F.floor(F.col("g") / p.fan_in).alias("g"), F.col("g").alias("at"), "keys") for level in levels[1:-1]]
    by = ("kind", "bucket", "g")
    for want in reversed(wants):
        known = want.groupBy(*by).cogroup(known.withColumnRenamed("at", "g").groupBy(*by)).applyInArrow(answer, "kind string, bucket int, at long, keys binary, vals binary")
    return known


# -- the tree --------------------------------------------------------------------------------------------------
def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 1/2: eight steps of its recurrence, then Stirling's series."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 9
        shift += np.where(small, np.log(y), 0)
        y = np.where(small, y + 1, y)
    z = 1 / y
    return (y - 0.5) * np.log(y) - y + 0.5 * log(2 * np.pi) + z * (1 / 12 - z * z * (1 / 360 - z * z / 1260)) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a run with so many zeros and ones."""
    a, b = zeros.astype(float), ones.astype(float)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - log(np.pi)


class Nodes:
    """All nodes of one depth and bit level: keys (context << 8 | byte) are sorted, so a node's are neighbours."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, level: int):
        self.level = level
        name = keys >> np.uint64(8 - level)
        first = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        self.name = name[first]  # context << level | bits so far
        self.of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        bit = (keys >> np.uint64(7 - level)) & np.uint64(1)
        total, ones = np.add.reduceat(counts, first), np.add.reduceat(np.where(bit == 1, counts, 0), first)
        self.own = log_kt(total - ones, ones)
        self.one = (ones + 0.5) / (total + 1)

    def parents(self, above: "Nodes") -> np.ndarray:
        k = np.uint64(self.level)
        name = (self.name >> (k + np.uint64(8))) << k | (self.name & ((np.uint64(1) << k) - np.uint64(1)))
        return np.searchsorted(above.name, name)

    def weigh(self, below: np.ndarray | None) -> np.ndarray:
        """log of the weighted probability; sets the share of the node's own estimate. below: the children's sum."""
        if below is None:
            self.share = np.ones(len(self.own))
            return self.own
        whole = np.logaddexp(_HALF + self.own, _HALF + below)
        self.share = np.exp(_HALF + self.own - whole)
        return whole


def shorter(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts with the oldest context byte dropped, and the place of each old key among them."""
    k, where = np.unique((keys >> np.uint64(16)) << np.uint64(8) | (keys & np.uint64(255)), return_inverse=True)
    return k, np.bincount(where, counts, len(k)).astype(np.int64), where


class Deep:
    """Depths 5 to 3 of one bucket, and its part of the children's sums for depth 2."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        ks, cs, self.up = [keys], [counts], []
        for _ in range(DEPTH - 2):
            k, n, up = shorter(ks[-1], cs[-1])
            ks.append(k)
            cs.append(n)
            self.up.append(up)
        self.keys2, self.counts2, self.levels, self.below2 = ks[-1], cs[-1], [], []
        for level in range(8):
            nodes = [Nodes(k, n, level) for k, n in zip(ks, cs, strict=True)]
            whole = nodes[0].weigh(None)
            for below, above in zip(nodes[:-2], nodes[1:-1], strict=True):
                whole = above.weigh(np.bincount(below.parents(above), whole, len(above.name)))
            self.below2.append(np.bincount(nodes[-2].parents(nodes[-1]), whole, len(nodes[-1].name)))
            self.levels.append(nodes[:-1])

    def part(self) -> dict:
        return {"keys": packed(self.keys2), "counts": packed(self.counts2), "below": [packed(x) for x in self.below2]}


def combined(parts: list[dict]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sums of the buckets' parts of depth 2: keys, counts, and the children's sums by level."""
    keys, counts = [unpacked(r["keys"], np.uint64) for r in parts], [unpacked(r["counts"], np.int64) for r in parts]
    below = []
    for level in range(8):
        name, where = np.unique(np.concatenate([np.unique(k >> np.uint64(8 - level)) for k in keys]), return_inverse=True)
        below.append(np.bincount(where, np.concatenate([unpacked(r["below"][level], np.float64) for r in parts]), len(name)))
    return *added(keys, counts), below


class Top:
    """Depths 2, 1 and 0, and what they add to a prediction: own + rest * deeper."""

    def __init__(self, keys2: np.ndarray, counts2: np.ndarray, below2: list[np.ndarray]):
        keys1, counts1, _ = shorter(keys2, counts2)
        keys0, counts0, _ = shorter(keys1, counts1)
        self.levels = []
        for level in range(8):
            two, one, zero = (Nodes(k, c, level) for k, c in ((keys2, counts2), (keys1, counts1), (keys0, counts0)))
            up1, up0 = two.parents(one), one.parents(zero)
            w2 = two.weigh(below2[level])
            w1 = one.weigh(np.bincount(up1, w2, len(one.name)))
            zero.weigh(np.bincount(up0, w1, len(zero.name)))
            own0, rest0 = zero.share * zero.one, 1 - zero.share
            own1, rest1 = own0[up0] + rest0[up0] * one.share * one.one, rest0[up0] * (1 - one.share)
            self.levels.append((two.name, own1[up1] + rest1[up1] * two.share * two.one, rest1[up1] * (1 - two.share)))

    def log10(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of the probability of the byte of each key after its context."""
        deep, out = Deep(keys, counts), np.zeros(len(keys))
        for level, nodes in enumerate(deep.levels):
            name, own, rest = self.levels[level]
            one, place, of = nodes[0].one[nodes[0].of], np.arange(len(keys)), nodes[0].of
            for up, n in zip(deep.up, nodes[1:], strict=False):
                place = up[place]
                of = n.of[place]
                one = n.share[of] * n.one[of] + (1 - n.share[of]) * one
            k, last = np.uint64(level), nodes[-1]
            above = (last.name >> (k + np.uint64(8))) << k | (last.name & ((np.uint64(1) << k) - np.uint64(1)))
            at = np.searchsorted(name, above)[of]
            one = own[at] + rest[at] * one
            out += np.log10(np.where((keys >> np.uint64(7 - level)) & np.uint64(1) == 1, one, 1 - one))
        return out


def top_of(sums: DataFrame, buckets: int, p: Params) -> tuple[Top | None, int, int]:
    """The top of the tree and the number of training words and of distinct ones, from the buckets' sums."""

    def parts(batches):
        for batch in batches:
            for row in batch.to_pylist():
                k, n = unpacked(row["keys"], np.uint64), unpacked(row["counts"], np.int64)
                words = n if row["kind"] == "w" else n[:0]
                part = Deep(k, n).part() if row["kind"] == "g" and len(k) else {"keys": b"", "counts": b"", "below": []}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]], pa.int32()), pa.array([int(words.sum())], pa.int64()), pa.array([int((words > 0).sum())], pa.int64()), pa.array([part["keys"]], pa.binary()), pa.array([part["counts"]], pa.binary()), pa.array([part["below"]], pa.list_(pa.binary()))],
                    names=["g", "tokens", "distinct", "keys", "counts", "below"],
                )

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        some = [r for r in table.to_pylist() if r["keys"]]
        keys, counts, below = combined(some) if some else (np.zeros(0, np.uint64), np.zeros(0, np.int64), [])
        numbers = {c: pa.array([sum(table[c].to_pylist())], pa.int64()) for c in ("tokens", "distinct")}
        return pa.table({"g": pa.array([key[0].as_py()], pa.int32())} | numbers | {"keys": pa.array([packed(keys)], pa.binary()), "counts": pa.array([packed(counts)], pa.binary()), "below": pa.array([[packed(x) for x in below]], pa.list_(pa.binary()))})

    schema = "g int, tokens long, distinct long, keys binary, counts binary, below array<binary>"
    rows = in_arrow(sums, parts, schema)
    while buckets > 1:
        buckets = -(-buckets // p.fan_in)
        rows = rows.withColumn("g", F.floor(F.col("g") / p.fan_in).cast("int")).groupBy("g").applyInArrow(add, schema)
    got = rows.toArrow().to_pylist()
    tokens, distinct = sum(r["tokens"] for r in got), sum(r["distinct"] for r in got)
    some = [r for r in got if r["keys"]]
    return (Top(*combined(some)) if some else None), tokens, distinct


def score(docs: DataFrame, held_out: Column, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    ``base_score`` is the smoothed word model's log10 probability, ``score`` the context tree's.
    """
    chunks = settled(chunked(docs, held_out, p))
    size = chunks.agg(F.count("*").alias("n"), F.sum("train").alias("train")).first()
    count, train = size["n"], size["train"] or 0
    groups, buckets = max(1, -(-count // p.fan_in)), min(p.most_buckets, max(12, count))
    asked = settled(requests(chunks, buckets, p).withColumn("g", F.pmod(F.xxhash64("chunk"), F.lit(groups).cast("long"))))
    levels = merged(asked, groups, p)
    sums = levels[-1].drop("g")
    top, tokens, distinct = top_of(sums, buckets, p)
    shared = docs.sparkSession.sparkContext.broadcast(top)
    total, kinds = tokens + train, distinct + (train > 0)

    def model(batches):
        for batch in batches:
            for row in batch.to_pylist():
                k, n = unpacked(row["keys"], np.uint64), unpacked(row["counts"], np.int64)
                values = n if row["kind"] == "w" else shared.value.log10(k, n).astype(np.float32) if len(k) else np.zeros(0, np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([row["kind"]]), pa.array([row["bucket"]], pa.int32()), pa.array([row["keys"]], pa.binary()), pa.array([packed(values)], pa.binary())], names=["kind", "bucket", "keys", "vals"])

    known = in_arrow(sums, model, "kind string, bucket int, keys binary, vals binary").withColumn("at", F.lit(0).cast("long"))
    answers = answered([asked.withColumnRenamed("chunk", "at"), *levels], known, p).withColumnRenamed("at", "chunk")
    end_known, end_score = int(train > 0), log10((train + 0.5) / (total + 0.5 * (kinds + 1)))

    def scored(key: tuple[pa.Scalar, ...], packs: pa.Table, answers_: pa.Table) -> pa.Table:
        out = []
        rows = answers_.to_pylist()
        table = {}
        for kind, dtype in (("g", np.float32), ("w", np.int64)):
            mine = [r for r in rows if r["kind"] == kind]
            k = np.concatenate([unpacked(r["keys"], np.uint64) for r in mine] or [np.zeros(0, np.uint64)])
            table[kind] = pd.Index(k), np.concatenate([unpacked(r["vals"], dtype) for r in mine] or [np.zeros(0, dtype)])
        for row in packs.to_pylist():
            c = chunk_of(row)
            n = len(c.starts)
            bits, base, words, seen = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for at, stop in c.slices(p.slice_bytes):
                keys, coded, hashed, starts = c.part(at, stop)
                value = np.zeros(len(keys))
                value[coded] = table["g"][1][table["g"][0].get_indexer(keys[coded])]
                where, sums_ = c.sums(at, stop, None, value)
                bits[where] += sums_
                if len(hashed):
                    times = table["w"][1][table["w"][0].get_indexer(hashed)]
                    for store, v in ((base, np.log10((times + 0.5) / (total + 0.5 * (kinds + 1)))), (words, np.ones(len(times), np.int64)), (seen, (times > 0).astype(np.int64))):
                        where, sums_ = c.sums(at, stop, starts, v)
                        store[where] += sums_.astype(store.dtype)
            length = np.frombuffer(row["lengths"], "<i8")
            out.append(pa.table({
                "doc_id": pa.array(row["ids"], packs["ids"].type.value_type), "held_out": np.arange(n) >= c.train, "n_tokens": words + 1, "n_known": seen + end_known,
                "train_tokens": np.full(n, total), "base_score": base + end_score, "score": bits, "n_bytes": length, "bits_per_byte": -bits / log10(2) / (length + 1),
            }))
        return pa.concat_tables(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, schema)
