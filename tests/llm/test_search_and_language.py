"""Block search and context-tree scores against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from odd import TEXTS, empty_docs, odd_docs
from pyspark.sql import functions as F

from strata.llm import block_search, context_tree
from strata.llm.common import fold

VECTORS = "vec_id long, embedding array<float>, tile int, g int, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS)


def nearest(rows, k):
    use = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v, np.float32))]
    out = []
    for i, v in use:
        if i % 20 == 0:
            found = sorted((-float(v @ w), j) for j, w in use if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return out


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=1e-300)


@pytest.mark.parametrize("p", [block_search.Params(), block_search.Params(k=5, tile=16, query_block=3, group_rows=40, fan_in=2)])
def test_search_equals_brute_force(spark, p):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=24) * 10.0 ** rng.integers(-3, 3)).tolist()) for i in range(300)]
    got = block_search.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, p).orderBy("query_id", "rank").collect()
    same([tuple(r) for r in got], sorted(nearest(rows, p.k)))


def test_search_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, -1.0]), (3, [1.0, 5.0]), (3, [1.0, 5.0]), (20, [0.0, 1.0]), (40, None), (60, []), (80, [0.0, 0.0]),
            (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (None, [9.0, 9.0]), (160, [1.0, 2.0, 3.0]), (5, [-1.0, 0.0])]
    got = block_search.search(vectors(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    same([tuple(r) for r in got], sorted(nearest(rows, 20)))
    assert [r["vec_id"] for r in got if r["query_id"] == 0] == [1, 2, 3, 3, 20, 5]  # ties by id; the repeat counts
    assert block_search.search(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_search_of_extreme_vectors(spark):
    """Finite doubles whose products overflow, or whose parts are the least there are, are found like any other."""
    rows = [(0, [1e200, 1e200]), (1, [1e200, 1e150]), (2, [5e-324, 0.0]), (3, [1e-320, -1e-320]), (4, [-1e308, 1.0]), (5, [1.0, 1.0]), (20, [1e-310, 1e-310]), (40, [5e-324, 5e-324]), (6, [1e300, -1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = block_search.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    want = []
    with np.errstate(all="ignore"):
        for i, v in rows:
            if i % 20 == 0:
                found = sorted((-float(np.array(v) @ np.array(w)), j) for j, w in rows if j != i)
                want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    assert [tuple(r)[:3] for r in got] == [w[:3] for w in sorted(want)]
    assert all(a["score"] == b[3] or abs(a["score"] - b[3]) <= 1e-12 * abs(b[3]) for a, b in zip(got, sorted(want), strict=True))


def test_certified_bounds_hold():
    rng = np.random.default_rng(5)
    make = lambda n: rng.normal(size=(n, 40)) * rng.lognormal(size=(n, 1))

    def tile(first, v):
        scale = np.abs(v).max(axis=1) / 127
        return block_search.Tile({"n": len(v), "dim": 40, "ids": np.arange(first, first + len(v)).astype("<i8").tobytes(), "vectors": v.tobytes(), "codes": np.rint(v / scale[:, None]).astype(np.int8).tobytes(), "scales": scale.tobytes()})

    q, c = tile(0, make(30)), tile(1000, make(500))
    a, b = block_search.survivors(q, c, np.full(30, -np.inf), 10)
    best = np.argsort(-(q.vectors @ c.vectors.T), axis=1)[:, :10]
    kept = set(zip(a.tolist(), b.tolist()))
    assert all((i, j) in kept for i in range(30) for j in best[i].tolist())
    assert len(kept) < 30 * 100  # and most are pruned


# -- context tree ------------------------------------------------------------------------------------------------
def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def tree_scores(texts, train):
    """log10 probability of each text by a plain recursive tree of Krichevsky-Trofimov nodes."""
    depth, nodes, children = context_tree.DEPTH, {}, {}
    coded = [b"\xff" * depth + b" ".join(words(t)) + b"\xff" for t in texts]
    for s, learn in zip(coded, train):
        for i in range(depth, len(s) if learn else 0):
            for d in range(depth + 1):
                for k in range(8):
                    nodes.setdefault((s[i - d : i], k, s[i] >> (8 - k)), [0, 0])[s[i] >> (7 - k) & 1] += 1
    for c, k, b in nodes:
        if c:
            children.setdefault((c[1:], k, b), []).append((c, k, b))
    kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
    whole = {}
    for key in sorted(nodes, key=lambda x: -len(x[0])):
        own = kt(nodes[key])
        whole[key] = own if len(key[0]) == depth else np.logaddexp(math.log(0.5) + own, math.log(0.5) + sum(whole[c] for c in children.get(key, [])))

    def chance(context, byte):
        total = 0.0
        for k in range(8):
            bit, p = byte >> (7 - k) & 1, 0.5
            for d in range(depth, -1, -1):
                key = context[depth - d :], k, byte >> (8 - k)
                n = nodes.get(key, [0, 0])
                own = (n[bit] + 0.5) / (sum(n) + 1)
                share = 1 if d == depth else math.exp(math.log(0.5) + kt(n) - whole[key]) if key in nodes else 0.5
                p = share * own + (1 - share) * p
            total += math.log10(p)
        return total

    return [sum(chance(s[i - depth : i], s[i]) for i in range(depth, len(s))) for s in coded]


@pytest.mark.parametrize("p", [context_tree.Params(), context_tree.Params(chunk_bytes=600, slice_bytes=64, fan_in=2)])
def test_scores_equal_a_plain_tree(spark, p):
    rows = [(i, t[:400] if t else t) for i, t in TEXTS] + [(i, f"the {i} cat sat on the {'mat ' * (i % 5)}and The dog ran {i * i}") for i in range(20, 60)]
    got = context_tree.score(odd_docs(spark, rows).repartition(3), fold() == 1, p).collect()
    train = [i is None or zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    c = Counter(w for (_, t), learn in zip(rows, train) if learn for w in words(t))
    n, kinds = sum(c.values()) + sum(train), len(c) + 1
    want = []
    for (i, t), learn, s in zip(rows, train, tree_scores([t for _, t in rows], train)):
        seen = [c[w] for w in words(t)] + [sum(train)]
        want.append((-1 if i is None else i, not learn, len(seen), sum(x > 0 for x in seen), n, sum(math.log10((x + 0.5) / (n + 0.5 * (kinds + 1))) for x in seen), s))
    have = sorted((-1 if r["doc_id"] is None else r["doc_id"], *tuple(r)[1:7]) for r in got)
    want.sort()
    assert [r[:5] for r in have] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in have], [r[5:] for r in want], rtol=1e-6)


def test_probabilities_add_up():
    """After any context the 256 bytes' probabilities add up to one."""
    rng = np.random.default_rng(2)
    context = rng.integers(97, 101, (60, context_tree.DEPTH))
    byte = np.arange(256)
    keys = np.unique(np.concatenate([sum(int(c) << 8 * (context_tree.DEPTH - k) for k, c in enumerate(row)) + byte for row in context]).astype(np.uint64))
    counts = np.where(rng.random(len(keys)) < 0.02, rng.integers(1, 50, len(keys)), 0)
    deep = context_tree.Deep(keys, counts)
    top = context_tree.Top(*context_tree.combined([deep.part()]))
    total = np.bincount(np.unique(keys >> np.uint64(8), return_inverse=True)[1], 10 ** top.log10(keys, counts))
    assert np.allclose(total, 1)


def test_no_documents_and_no_training(spark):
    assert context_tree.score(empty_docs(spark), fold() == 1).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = context_tree.score(odd_docs(spark, [(i, "ab") for i in held]), fold() == 1).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isclose(r["score"], 24 * math.log10(0.5), rel_tol=1e-6) for r in rows)
