"""Quality classifier: random-indexing word vectors, pooled per document, into a two-layer network.

1. Every token bucket has a sparse random index vector (``nonzero`` entries of +1 or -1 out of ``dim``).
   One pass over *all* texts adds to each bucket the index vectors of the tokens within ``window``;
   these whole-number sums are added up per bucket by Spark, so they are exact and independent of task
   order. The table has ``buckets * dim`` numbers whatever the corpus, hence it may be broadcast.
2. A document's features are the mean and the spread of its tokens' unit vectors, the length of that
   mean and its log token count.
3. A two-layer numpy network learns from at most ``max_labelled`` labelled rows (documented bound); one
   of their folds is kept apart to fit the temperature by which its logits are divided.

Defined results: a null text is empty and has all-zero features, and is scored like any other; without
labels of both kinds every score is the smoothed share of label 1; repeated rows are scored each, but one text
per id is learned; columns
other than the id and text are never read. Only text feeds a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import KIND, Block, blocks, column_bytes, fold, hashes, in_arrow, labelled_sample, runs, sampled_texts


@dataclass(frozen=True)
class Params:
    buckets_log2: int = 14
    dim: int = 32
    nonzero: int = 2
    window: int = 2
    max_labelled: int = 20_000
    hidden: int = 24
    epochs: int = 40
    threshold: float = 0.3
    seed: int = 7


@dataclass(frozen=True)
class Model:
    params: Params
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -60, 60)))


def index_vectors(p: Params) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed)
    shape = (1 << p.buckets_log2, p.nonzero)
    return rng.integers(0, p.dim, shape), rng.choice(np.array([-1.0, 1.0]), shape)


def tokens(block: Block, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and part of every run of letters, of digits or of other signs."""
    starts, ends = runs(KIND[block.buf])
    ids = (hashes(block.buf, starts, ends) >> np.uint64(64 - p.buckets_log2)).astype(np.int64)
    return ids, block.part_of(starts)


def context_sums(texts: list[bytes], p: Params, pos: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Per bucket, the sum of the index vectors around its tokens."""
    total = np.zeros((1 << p.buckets_log2) * p.dim)
    for block in blocks(texts, 1 << 20):
        ids, part = tokens(block, p)
        for d in range(1, p.window + 1):
            same = part[d:] == part[:-d]
            left, right = ids[:-d][same], ids[d:][same]
            for word, context in ((left, right), (right, left)):
                for k in range(p.nonzero):
                    total += np.bincount(word * p.dim + pos[context, k], sign[context, k], len(total))
    return total


def pooled(texts: list[bytes], vectors: np.ndarray, p: Params) -> np.ndarray:
    """One row of features per text."""
    n, dim = len(texts), p.dim
    sums, squares, counts = np.zeros((n, dim)), np.zeros((n, dim)), np.zeros(n)
    for block in blocks(texts):
        ids, part = tokens(block, p)
        if not len(ids):
            continue
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        owner, v = block.owner[part[first]], vectors[ids]
        np.add.at(sums, owner, np.add.reduceat(v, first, axis=0))
        np.add.at(squares, owner, np.add.reduceat(v * v, first, axis=0))
        np.add.at(counts, owner, np.diff(np.append(first, len(ids))))
    some = np.maximum(counts, 1)[:, None]
    mean = sums / some
    spread = np.sqrt(np.maximum(squares / some - mean**2, 0))
    return np.hstack([mean, spread, np.linalg.norm(mean, axis=1, keepdims=True), np.log1p(counts)[:, None]])


def word_vectors(docs: DataFrame, p: Params) -> np.ndarray:
    """Unit vectors of all buckets from all texts; buckets never seen are zero."""
    pos, sign = index_vectors(p)
    names = [f"v{k}" for k in range(p.dim)]

    def gather(batches):
        total = np.zeros((1 << p.buckets_log2) * p.dim)
        for batch in batches:
            total += context_sums(column_bytes(batch, "text"), p, pos, sign)
        table = total.reshape(-1, p.dim).astype(np.int64)
        seen = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), *(pa.array(table[seen, k]) for k in range(p.dim))], names=["bucket", *names])

    schema = "bucket int, " + ", ".join(f"{x} long" for x in names)
    summed = in_arrow(docs.select("text"), gather, schema).groupBy("bucket").agg(*(F.sum(x).alias(x) for x in names)).toArrow()
    table = np.zeros((1 << p.buckets_log2, p.dim))
    if summed.num_rows:
        table[summed["bucket"].to_numpy()] = np.column_stack([summed[x].to_numpy() for x in names])
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    unit = table / np.maximum(norm, 1e-9)
    unit = np.where(norm > 0, unit - unit[norm[:, 0] > 0].mean(axis=0, keepdims=True) if norm.any() else unit, 0)
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, part: np.ndarray, vectors: np.ndarray, p: Params) -> Model:
    """Adam on the logistic loss of all folds but 4, then the temperature on fold 4."""
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(2 * p.dim + 2), np.ones(2 * p.dim + 2))
    share = (y.sum() + 1) / (len(y) + 2)
    flat = Model(p, vectors, mean, scale, np.zeros((2 * p.dim + 2, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)
    if len(np.unique(y)) < 2:
        return flat
    fit = part != 4 if len(np.unique(y[part != 4])) == 2 else np.ones(len(y), bool)
    rng = np.random.default_rng(p.seed)
    xs, ys = ((x - mean) / scale)[fit], y[fit].astype(float)
    w = [rng.normal(0, 1 / np.sqrt(xs.shape[1]), (xs.shape[1], p.hidden)), np.zeros(p.hidden), rng.normal(0, 1 / np.sqrt(p.hidden), p.hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for epoch in range(p.epochs):
        rate = 0.01 * (1 - epoch / p.epochs)
        order = rng.permutation(len(xs))
        for rows in np.array_split(order, max(1, len(order) // 128)):
            step += 1
            a, t = xs[rows], ys[rows]
            h = np.tanh(a @ w[0] + w[1])
            d = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -60, 60))) - t) / len(rows)
            back = np.outer(d, w[2]) * (1 - h * h)
            for k, g in enumerate((a.T @ back + 1e-4 * w[0], back.sum(axis=0), h.T @ d + 1e-4 * w[2], d.sum(keepdims=True))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    held = ~fit if (~fit).any() else fit
    z = np.tanh((x[held] - mean) / scale @ w[0] + w[1]) @ w[2] + w[3]
    candidates = np.exp(np.linspace(-1.5, 2.5, 161))
    loss = [np.mean(np.logaddexp(0, z / t) - y[held] * z / t) for t in candidates]
    return Model(p, vectors, mean, scale, w[0], w[1], w[2], float(w[3][0]), float(candidates[int(np.argmin(loss))]))


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params(), label: str = "quality") -> Model:
    """Word vectors from every text, then the network from the bounded labelled sample."""
    vectors = word_vectors(docs, p)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    names = [f"f{k}" for k in range(2 * p.dim + 2)]

    def features(batches):
        for batch in batches:
            x = pooled(column_bytes(batch, "text"), shared.value, p)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *(pa.array(x[:, k]) for k in range(len(names)))], names=["doc_id", "y", "part", *names])

    rows = sampled_texts(docs, labelled_sample(labels, label, p.max_labelled)).select("doc_id", "y", fold().cast("int").alias("part"), "text")
    got = in_arrow(rows, features, "doc_id long, y int, part int, " + ", ".join(f"{x} double" for x in names)).toArrow()
    x = np.column_stack([got[c].to_numpy() for c in names]) if got.num_rows else np.zeros((0, len(names)))
    order = np.lexsort((*x.T[:3], got["doc_id"].to_numpy()))
    return train(x[order], got["y"].to_numpy()[order], got["part"].to_numpy()[order], vectors, p)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            m = shared.value
            s = m.probability(pooled(column_bytes(batch, "text"), m.vectors, m.params))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= m.params.threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", (fold() == 0).alias("held_out"), "text")
    return in_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def accept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            m = shared.value
            s = m.probability(pooled(column_bytes(batch, "text"), m.vectors, m.params))
            yield batch.filter(pa.array(s >= m.params.threshold))

    return in_arrow(docs, run, docs.schema)
