"""Toxicity by multiple-instance learning: sentences are instances, a document is a bag.

A sentence's score is a logistic function of the weights of its distinct words; a document is toxic if any of its
sentences is (noisy-or: ``1 - prod(1 - p_s)``). The chance of a sentence without evidence is taken out of every
factor and counted once a document (the leak), so that a long clean document is no likelier toxic than a short
one. Only document labels are learned from: the noisy-or
likelihood's gradient shares a document's blame among its sentences, which afterwards locates the offending
ones. Features are lower-cased runs of letters and their first 4 to 7 bytes (insults are inflected), hashed to
``2**buckets_log2`` weights (a fixed size, hence safe to broadcast; bucket 0 stays empty). Weights are learned
for the ``max_features`` features in at least ``min_docs`` sampled documents that tell the labels apart most
surely, with an L1 penalty that sets weights of chance words to zero.

The fit uses at most ``max_labelled`` labelled documents, whole and of any length, until they hold
``max_sample_bytes`` bytes; both are documented bounds of the sample. It reads the sample twice on the executors:
once for the documents of each label that have a feature, of which Spark sums the counts and picks the features,
and once for the pairs of sentence and picked feature. The driver gets the picked features and these pairs only.
Fit and scoring take texts in blocks.

Defined results: null and empty texts have one empty sentence; without labels of both kinds every sentence
has the smoothed share of label 1, and without any label a share of a quarter, so that nothing is predicted or
rejected; repeated rows are scored each, but one text per id is learned; only text feeds a score. Sentences end at
``. ! ?`` and at line feeds; their places count bytes of the text as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import KIND, Block, blocks, column_bytes, fold, hashes, in_arrow, labelled_sample, runs, sampled_texts, settled

_STOP = np.zeros(256, bool)
_STOP[[10, 33, 46, 63]] = True
_LETTER = (KIND == 1).astype(np.uint8)


@dataclass(frozen=True)
class Params:
    buckets_log2: int = 20
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    max_labelled: int = 8_000
    max_sample_bytes: int = 32 << 20
    max_features: int = 4_096
    min_docs: int = 4
    steps: int = 200
    l1: float = 0.3
    rate: float = 2.0
    bias_rate: float = 0.1
    threshold: float = 0.5


@dataclass(frozen=True)
class Model:
    params: Params
    weights: np.ndarray
    bias: float
    labelled: int  # documents learned from

    def toxic(self, score: np.ndarray) -> np.ndarray:
        return score >= self.params.threshold


def instances(block: Block, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets (a row per word), the sentence of each word, the part of each sentence, their ends.

    Sentences are the stretches between stops; every part ends with a line feed, so none spans two parts. Words
    are lower-cased, which can change the length of some letters but neither adds nor moves a stop: the n-th stop
    of the lower-cased text is the n-th of the text.
    """
    data = block.buf.tobytes()
    buf = np.frombuffer(data.lower() if data.isascii() else data.decode("utf-8", "replace").lower().encode(), np.uint8)
    starts, ends = runs(_LETTER[buf])
    ids = (hashes(buf, starts, ends, p.prefixes) >> np.uint64(64 - p.buckets_log2)).astype(np.int32)
    stops = np.flatnonzero(_STOP[block.buf])
    return ids, np.searchsorted(np.flatnonzero(_STOP[buf]), starts), block.part_of(stops), stops


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def bags(texts: list[bytes], m: Model) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """Per text: its score, and start, end and chance of the sentences to blame in their order.

    These are the sentences with a chance of a half at least, or the likeliest one where there is none.
    """
    n = len(texts)
    leak = softplus(m.bias)
    none, blamed = np.full(n, leak), [[] for _ in range(n)]
    best: list[tuple[float, int, int] | None] = [None] * n
    ahead = np.zeros(n, np.int64)  # bytes of a text in its earlier pieces
    for block in blocks(texts):
        ids, sentence, part, stops = instances(block, m.params)
        word, column = np.nonzero(m.weights[ids])
        found = np.unique(sentence[word].astype(np.int64) << m.params.buckets_log2 | ids[word, column])
        used = np.zeros(len(stops), bool)
        used[sentence] = True
        weight = m.weights[found & ((1 << m.params.buckets_log2) - 1)]
        z = m.bias + np.bincount(found >> m.params.buckets_log2, weight, len(stops))[used]
        owner, begin, end = block.owner[part[used]], np.concatenate(([0], stops[:-1] + 1))[used], stops[used]
        np.add.at(none, owner, np.maximum(softplus(z) - leak, 0))
        shift = ahead[owner] - block.starts[part[used]]
        for k in np.flatnonzero(z >= 0):
            blamed[owner[k]].append((int(begin[k] + shift[k]), int(end[k] + shift[k]), float(1 / (1 + np.exp(-z[k])))))
        order = np.lexsort((begin, -z, owner))
        first = order[np.concatenate(([True], owner[order][1:] != owner[order][:-1]))] if len(order) else order
        for k in first:
            if best[owner[k]] is None or z[k] > best[owner[k]][0]:
                best[owner[k]] = (float(z[k]), int(begin[k] + shift[k]), int(end[k] + shift[k]))
        sizes = np.diff(np.append(block.starts, len(block.buf))) - 1
        np.add.at(ahead, block.owner, sizes)
    for rows, likeliest in zip(blamed, best, strict=True):
        if not rows and likeliest:
            rows.append((*likeliest[1:], 1 / (1 + np.exp(-likeliest[0]))))
    return -np.expm1(-none), blamed


def train(docs: list[tuple[int, np.ndarray]], y: np.ndarray, features: np.ndarray, p: Params) -> Model:
    """docs: number of sentences, and pairs ``sentence * len(features) + feature``, of each document.

    Proximal Adagrad on the noisy-or loss.
    """
    weights = np.zeros(1 << p.buckets_log2, np.float32)
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.25
    if len(np.unique(y)) < 2:
        return Model(p, weights, float(np.log(share / (1 - share))), len(y))
    sentences = np.array([n for n, _ in docs], np.int64)
    offset = np.cumsum(sentences) - sentences
    owner = np.repeat(np.arange(len(docs)), sentences)
    width = max(1, len(features))
    row = np.concatenate([pairs // width + lo for (_, pairs), lo in zip(docs, offset, strict=True)])
    col = np.concatenate([pairs % width for _, pairs in docs])
    w, bias = np.zeros(len(features)), -5.0
    gw, gb = np.full(len(features), 1e-3), 1e-3
    for _ in range(p.steps):
        z = bias + np.bincount(row, w[col], len(owner))
        leak, floor = softplus(bias), 1 / (1 + np.exp(-bias))
        none = leak + np.bincount(owner, np.maximum(softplus(z) - leak, 0), len(docs))  # -log(1 - P)
        chance = np.where(z >= bias, 1 / (1 + np.exp(-np.clip(z, -60, 60))), 0)
        pull = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(none, 60)), 1e-6), 1.0)
        g = pull[owner] * chance
        dw = np.bincount(col, g[row], len(w))
        db = pull.sum() * floor + (pull[owner] * (chance - np.where(z >= bias, floor, 0))).sum()
        gw += dw * dw
        gb += db * db
        rate = p.rate / np.sqrt(gw)
        w = w - rate * dw
        w = np.sign(w) * np.maximum(np.abs(w) - rate * p.l1, 0)
        bias = min(bias - p.bias_rate / np.sqrt(gb) * db, -2.0)
    weights[features] = w
    return Model(p, weights, float(bias), len(y))


def telling(rows: DataFrame, share: float, p: Params) -> np.ndarray:
    """The buckets that tell the labels of the sample ``rows`` (y, text) apart most surely, in order.

    Tasks count the documents of each label that have a feature; Spark sums the counts and ranks the features.
    """

    def run(batches):
        docs, toxic = (np.zeros(1 << p.buckets_log2, np.int64) for _ in range(2))
        for batch in batches:
            for text, y in zip(column_bytes(batch, "text"), batch.column("y").to_pylist(), strict=True):
                present = np.unique(np.concatenate([np.unique(instances(b, p)[0]) for b in blocks([text])] or [np.zeros(0, np.int32)]))
                docs[present] += 1
                toxic[present] += y
        found = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(docs[found]), pa.array(toxic[found])], names=["bucket", "docs", "toxic"])

    counts = in_arrow(rows.select("y", "text"), run, "bucket int, docs long, toxic long").groupBy("bucket").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
    sure = (F.col("toxic") - F.lit(share) * F.col("docs")) / F.sqrt(F.lit(share * (1 - share)) * F.col("docs"))
    ranked = counts.where((F.col("docs") >= p.min_docs) & (F.col("bucket") != 0)).withColumn("sure", sure).where("sure <> 0")
    best = ranked.orderBy(F.desc(F.abs("sure")), "bucket").limit(p.max_features).select("bucket")
    return np.sort(np.array([r["bucket"] for r in best.collect()], np.int64))


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params(), label: str = "toxic") -> Model:
    rows = settled(sampled_texts(docs, labelled_sample(labels, label, p.max_labelled).drop("part"), p.max_sample_bytes))
    held = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    share = (held.get(1, 0) + 1) / (sum(held.values()) + 2)
    features = telling(rows, share, p) if len(held) == 2 else np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(features)

    def pairs(text: bytes, column: np.ndarray) -> tuple[int, bytes]:
        found, count, width = [], 0, max(1, len(shared.value))
        for block in blocks([text]):
            ids, sentence, _, _ = instances(block, p)
            used, place = np.unique(sentence, return_inverse=True)
            word, feature = np.nonzero(column[ids] >= 0)
            found.append(np.unique((place[word] + count).astype(np.int64) * width + column[ids[word, feature]]))
            count += len(used)
        return max(count, 1), np.concatenate(found or [np.zeros(0, np.int64)]).astype("<i8").tobytes()

    def run(batches):
        column = np.full(1 << p.buckets_log2, -1, np.int64)
        column[shared.value] = np.arange(len(shared.value))
        for batch in batches:
            made = [pairs(x, column) for x in column_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array([n for n, _ in made], pa.int64()), pa.array([x for _, x in made], pa.binary())], names=["doc_id", "y", "sentences", "pairs"]
            )

    got = in_arrow(rows.select("doc_id", "y", "text"), run, "doc_id long, y int, sentences long, pairs binary", rows=100).toArrow().to_pylist()
    got.sort(key=lambda r: r["doc_id"])
    bag = [(r["sentences"], np.frombuffer(r["pairs"], "<i8")) for r in got]
    return train(bag, np.array([r["y"] for r in got], np.int64), features, p)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, toxic_sentences, sentences: one row per input row.

    ``sentences`` has the places of the sentences to blame (bytes of the text, from ``start`` up to ``end``) with
    their chances; ``toxic_sentences`` counts those of a half at least.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())])

    def run(batches):
        for batch in batches:
            s, blamed = bags(column_bytes(batch, "text"), shared.value)
            hit = shared.value.toxic(s).astype(np.int32)
            count = [sum(c >= 0.5 for _, _, c in rows) for rows in blamed]
            rows = pa.array([[{"start": a, "end": b, "chance": c} for a, b, c in rows] for rows in blamed], pa.list_(place))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array(hit), pa.array(count, pa.int64()), rows], names=["doc_id", "held_out", "score", "predicted", "toxic_sentences", "sentences"])

    rows = docs.select("doc_id", (fold() == 0).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_arrow(rows, run, f"doc_id {kind}, held_out boolean, score double, predicted int, toxic_sentences long, sentences array<struct<start: long, end: long, chance: double>>")


def accept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = bags(column_bytes(batch, "text"), shared.value)[0]
            yield batch.filter(pa.array(~shared.value.toxic(s)))

    return in_arrow(docs, run, docs.schema)
