"""N-gram join against brute force, the learned operators' held-out accuracy, and the pipeline."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd import TEXTS, empty_docs, odd_docs
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import ngram_join, quality_net, queries, toxicity_mil
from strata.llm.common import blocks, hashes, labelled_sample, read_table, sampled_texts

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def gram_set(text):
    w = [x for x in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").replace("\n", " ").replace("\t", " ").split(" ") if x]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """(links, group) of every row by comparing all pairs."""
    sets = [gram_set(t) for _, t in rows]
    links, group = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                group[root(a)] = root(b)
    return links, [root(x) for x in range(len(rows))]


def near_copies(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, n = [], 1000
    for size in (40, 9, 3, 2, 2, 1, 1, 1):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(40, 120))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((n, " ".join(words)))
            n += 1
    return rows + [(n + k, rows[k][1]) for k in range(20)]


@pytest.mark.parametrize("p", [ngram_join.Params(), ngram_join.Params(block=8, bitmap_log2=6), ngram_join.Params(block=16, range_grams=48)])
def test_join_equals_all_pairs(spark, p):
    rows = TEXTS + near_copies()
    links, group = brute(rows)
    got = ngram_join.join(odd_docs(spark, rows).repartition(4), p).collect()
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = sorted(((i, least.get(g), n) for (i, _), g, n in zip(rows, group, links)), key=key)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=key) == want
    assert max(links) > 20


def test_join_on_the_small_table(spark):
    rows = [tuple(r) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    links, group = brute(rows)
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(least.get(g, i), i)
    want = {i: (least[g], n) for (i, _), g, n in zip(rows, group, links)}
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in queries.op4_ngram_join(spark, SMALL).collect()} == want


def test_what_a_task_holds_does_not_grow_with_texts(spark):
    """Comparisons go range by range; only sizes that may reach the similarity are compared, and all of those."""
    p = ngram_join.Params(range_grams=1000)
    rng = np.random.default_rng(4)
    sets = {b"%03d" % k: np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for k, n in enumerate([40, 50, 51, 63, 64, 4000, 5000, 5001, 5002, 90_000])}
    nodes = spark.createDataFrame([(c, b"r", len(s), 1) for c, s in sets.items()], "cls binary, root binary, size long, copies long")
    grams = spark.createDataFrame([(c, s.tobytes()) for c, s in sets.items()], "cls binary, grams binary")
    rows = ngram_join.sent(grams.join(ngram_join.dealt(nodes, p), "cls"), p).collect()
    held, met = Counter(), {}
    for r in rows:
        target = tuple(r[c] for c in ("lo", "hi", "i", "k"))
        held[target, r["at"]] += len(r["grams"]) // 8
        met.setdefault(target, {False: set(), True: set()})[r["far"]].add(bytes(r["cls"]))
    assert max(held.values()) <= 2 * p.range_grams
    pairs = Counter()
    for (lo, hi, i, k), sides in met.items():
        itself = lo == hi and i == k
        pairs.update((min(a, b), max(a, b)) for a in sides[False] for b in (sides[False] if itself else sides[True]) if not itself or a < b)
    assert set(pairs.values()) == {1}
    near = {(a, b) for a in sets for b in sets if a < b and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b]))}
    assert near <= set(pairs) and (b"000", b"009") not in pairs


def test_a_star_and_repeats_are_spread(spark):
    edges = spark.createDataFrame([(f"{k:05d}".encode(), b"00000") for k in range(1, 3000)] + [(b"a", b"b"), (b"b", b"c")], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in ngram_join.components(edges).collect()}
    assert len(got) == 3003 and {v for k, v in got.items() if k[:1] == b"0"} == {b"00000"} and got[b"c"] == b"a"
    rows = [(7, "the same few words in every row of them")] * 500 + [(k, "") for k in range(300)] + [(9000, "another text that stands quite alone here")]
    docs = odd_docs(spark, rows)
    assert sorted(r["n_links"] for r in ngram_join.join(docs).collect()) == [0] * 301 + [499] * 500
    assert sorted(r["doc_id"] for r in ngram_join.one_of_each(docs).collect()) == sorted([7, *range(300), 9000])


def test_one_of_each_group_stays(spark):
    rows = TEXTS + near_copies()
    docs = odd_docs(spark, rows)
    kept = ngram_join.one_of_each(docs.repartition(3))
    assert kept.schema == docs.schema
    _, group = brute(rows)
    empty = [k for k, (_, t) in enumerate(rows) if not gram_set(t)]
    least = {}
    for k, g in enumerate(group):
        if k not in empty:
            least[g] = min((rows[k][0] is not None, rows[k][0] or 0), least.get(g, (True, 1 << 60)))
    want = sorted([*((i if some else -1) for some, i in least.values()), *(-1 if rows[k][0] is None else rows[k][0] for k in empty)])
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == want
    assert ngram_join.one_of_each(empty_docs(spark)).count() == 0
    assert ngram_join.join(empty_docs(spark)).count() == 0


def test_banding_reaches_its_recall():
    for s, recall in ((0.8, 0.999), (0.6, 0.95), (0.9, 0.99)):
        bands, rows = ngram_join.banding(s, recall, 128)
        assert bands * rows <= 128 and 1 - (1 - s**rows) ** bands >= recall
        assert ngram_join.banding(s, recall, 128)[1] >= 2


def test_long_chains_are_followed(spark):
    n = 200
    edges = spark.createDataFrame([(f"{k:05d}".encode(), f"{k + 1:05d}".encode()) for k in range(n)] + [(b"x", b"y")], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in ngram_join.components(edges).collect()}
    assert len(got) == n + 3 and {v for k, v in got.items() if k[:1] == b"0"} == {b"00000"} and got[b"y"] == b"x"


# -- learned operators -------------------------------------------------------------------------------------------
@pytest.mark.parametrize("module, label, least", [(quality_net, "quality", 0.95), (toxicity_mil, "toxic", 0.94)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "labels")
    model = module.fit(docs, labels)
    rows = module.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r[label] for r in rows]) >= least
    odd = module.score(odd_docs(spark), model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in odd)
    assert len({r["score"] for r in odd if r["doc_id"] in (2, 3, 4)}) == 1  # null, empty and blank alike
    kept = module.accept(odd_docs(spark), model)
    assert kept.columns == odd_docs(spark).columns and kept.count() == sum(r["predicted"] == (1 if label == "quality" else 0) for r in odd)
    assert module.score(empty_docs(spark), model).count() == 0


@pytest.mark.parametrize("module", [quality_net, toxicity_mil])
def test_without_labels_every_score_is_the_share(spark, module):
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    scores = [r["score"] for r in module.score(odd_docs(spark, TEXTS[1:4]), module.fit(odd_docs(spark), labels)).collect()]
    # no label at all: half of them good, a quarter toxic, so that nothing is predicted to be
    assert set(scores) == {0.5} if module is quality_net else max(abs(x - 0.25) for x in scores) < 1e-9
    assert module.score(odd_docs(spark), module.fit(empty_docs(spark), labels)).count() == len(TEXTS)


def test_only_the_text_feeds_a_score(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    model = quality_net.fit(docs, labels)
    other = docs.select((F.col("doc_id") * 7 + 3).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("s").alias("source"))
    assert sorted(r["score"] for r in quality_net.score(other, model).collect()) == sorted(r["score"] for r in quality_net.score(docs, model).collect())


def test_offending_sentence_is_located(spark):
    """Only whole documents are labelled; the sentence to blame is found all the same."""
    rng = random.Random(3)
    sentence = lambda bad: " ".join(["vermin" if bad and k == 4 else rng.choice("abcdefghij") * rng.randint(1, 4) for k in range(9)]) + ". "
    rows = [(k, "".join(sentence(k % 4 == 0 and j == 2) for j in range(6))) for k in range(400)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    model = toxicity_mil.fit(odd_docs(spark, rows), labels)
    text = "A calm line here.\nYou aa bb VERMIN cc dd. Then calm again."
    rows = toxicity_mil.score(odd_docs(spark, [(1, text), (2, "All calm. " * 50)]), model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in rows] == [1, 0] and [r["toxic_sentences"] for r in rows] == [1, 0]
    places = lambda r, t: [t.encode()[s["start"] : s["end"]].decode().strip() for s in r["sentences"]]
    assert places(rows[0], text) == ["You aa bb VERMIN cc dd"]
    # places are those of the text as it is, also where lower-casing changes lengths, and after a cut into pieces
    text = "İİ İstanbul. " + "Calm words here. " * 40_000 + "A VERMIN İ line! Calm.\nvermin again? İ" + " İ" * 30
    row = toxicity_mil.score(odd_docs(spark, [(1, text)]), model).first()
    assert places(row, text) == ["A VERMIN İ line", "vermin again"] and row["toxic_sentences"] == 2
    plain = plain_bag(text, model)
    assert abs(row["score"] - plain[0]) < 1e-6 and len(plain[1]) == 2


def plain_bag(text, model):
    """Leaky noisy-or, sentence by sentence, in Python."""
    p = model.params
    leak, keep, blamed = math.log1p(math.exp(model.bias)), 0.0, []
    for k, sentence in enumerate(re.split("[.!?\n]", text.lower())):
        found = set()
        for word in re.findall(r"[a-z\u0080-\U0010ffff]+", sentence):
            data = word.encode()
            buf = np.frombuffer(data, np.uint8)
            found |= set((hashes(buf, np.array([0]), np.array([len(data)]), p.prefixes)[0] >> np.uint64(64 - p.buckets_log2)).tolist())
        if found:
            z = model.bias + sum(float(model.weights[i]) for i in sorted(found))
            keep += max(math.log1p(math.exp(z)) - leak, 0)
            if z >= 0:
                blamed.append(k)
    return -math.expm1(-leak - keep), blamed


def test_toxicity_equals_plain_noisy_or(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    model = toxicity_mil.fit(docs, labels, toxicity_mil.Params(min_docs=2))
    assert np.count_nonzero(model.weights)
    rows = {r["doc_id"]: r for r in toxicity_mil.score(docs, model).collect()}
    for d in docs.collect():
        want, blamed = plain_bag(d["text"], model)
        assert abs(rows[d["doc_id"]]["score"] - want) < 1e-6 and rows[d["doc_id"]]["toxic_sentences"] == len(blamed)


def test_features_are_those_of_plain_counts(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    p = toxicity_mil.Params(min_docs=2, max_features=60)
    rows = sampled_texts(docs, labelled_sample(labels, "toxic", p.max_labelled).drop("part"))
    held, toxic, y = Counter(), Counter(), []
    for r in rows.collect():
        found = {int(i) for b in blocks([r["text"].encode()]) for i in toxicity_mil.instances(b, p)[0].ravel()} - {0}
        held.update(found)
        toxic.update(found if r["y"] else ())
        y.append(r["y"])
    share = (sum(y) + 1) / (len(y) + 2)
    sure = {i: (toxic[i] - share * n) / math.sqrt(share * (1 - share) * n) for i, n in held.items() if n >= p.min_docs}
    best = sorted((i for i in sure if sure[i]), key=lambda i: (-abs(sure[i]), i))[: p.max_features]
    assert toxicity_mil.telling(rows, share, p).tolist() == sorted(best)


def test_toxicity_learns_long_texts_and_rejects_nothing_unlabelled(spark):
    rng = random.Random(4)
    sentence = lambda bad: " ".join(["vermin" if bad and k == 4 else rng.choice("abcdefghij") * rng.randint(1, 4) for k in range(9)]) + ". "
    rows = [(k, "".join(sentence(k % 2 == 0 and j == 2) for j in range(900 if k else 25_000))) for k in range(40)]
    assert min(len(x) for _, x in rows) > 20_000 and len(rows[0][1]) > 1 << 19
    labels = spark.createDataFrame([(k, 1, int(k % 2 == 0)) for k in range(40)], "doc_id long, quality int, toxic int")
    model = toxicity_mil.fit(odd_docs(spark, rows), labels)
    test = odd_docs(spark, [(1, "You aa bb vermin cc dd. Then calm again."), (2, "All calm. " * 50)])
    assert [r["predicted"] for r in toxicity_mil.score(test, model).orderBy("doc_id").collect()] == [1, 0]
    none = toxicity_mil.fit(odd_docs(spark, rows[:2]), labels.where("false"))
    assert toxicity_mil.accept(test, none).count() == 2
    assert all(r["score"] < 0.5 and not r["predicted"] and not r["toxic_sentences"] for r in toxicity_mil.score(test, none).collect())
    small = toxicity_mil.fit(odd_docs(spark, rows), labels, toxicity_mil.Params(max_sample_bytes=50_000))
    assert 1 <= small.labelled < 10


@pytest.mark.parametrize("module, label", [(quality_net, "quality"), (toxicity_mil, "toxic")])
def test_one_text_of_an_id_is_learned(spark, monkeypatch, module, label):
    seen = []
    train = module.train
    monkeypatch.setattr(module, "train", lambda *a: seen.append(max(len(x) for x in a[:2])) or train(*a))
    rows = [(1, f"words number {k % 50} of a text") for k in range(600)] + [(k, f"other text {k}") for k in range(2, 30)] + [(30, None), (30, "b"), (31, None)]
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 32)], "doc_id long, quality int, toxic int")
    bound = labelled_sample(labels, label, 10_000).select("doc_id")
    assert bound.where("doc_id in (1, 30, 31)").count() >= 2
    module.fit(odd_docs(spark, rows), labels)
    module.fit(odd_docs(spark, rows).orderBy(F.desc("text")), labels)
    assert seen == [bound.count()] * 2
    texts = [sorted((r["doc_id"], r["text"]) for r in sampled_texts(odd_docs(spark, x), labelled_sample(labels, label, 10_000)).collect()) for x in (rows, rows[::-1])]
    assert texts[0] == texts[1] and len(texts[0]) == bound.count()


def test_quality_equals_plain_pooling(spark):
    """Word vectors, features and scores by loops over tokens, contexts and units."""
    p = quality_net.Params(buckets_log2=7, dim=6, hidden=3)
    rows = TEXTS + near_copies()[:25]
    docs = odd_docs(spark, rows).repartition(3)
    pos, sign = quality_net.index_vectors(p)
    table = [[0.0] * p.dim for _ in range(1 << p.buckets_log2)]

    def buckets(text):
        found = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z\x80-\xff0-9\x20\x09-\x0d]+", (text or "").encode())
        return [int(hashes(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0]) >> (64 - p.buckets_log2) for t in found]

    for _, text in rows:
        ids = buckets(text)
        for at, word in enumerate(ids):
            for near in (*range(max(0, at - p.window), at), *range(at + 1, min(len(ids), at + p.window + 1))):
                for k in range(p.nonzero):
                    table[word][pos[ids[near], k]] += sign[ids[near], k]
    length = lambda v: math.sqrt(sum(x * x for x in v))
    unit = [[x / length(v) for x in v] if any(v) else None for v in table]
    some = [v for v in unit if v]
    middle = [sum(v[d] for v in some) / len(some) for d in range(p.dim)]
    unit = [[x - m for x, m in zip(v, middle)] if v else [0.0] * p.dim for v in unit]
    unit = [[x / max(length(v), 1e-9) for x in v] for v in unit]
    vectors = quality_net.word_vectors(docs, p)
    assert np.allclose(vectors, unit, atol=1e-5)

    rng = np.random.default_rng(3)
    n = 2 * p.dim + 2
    model = quality_net.Model(p, vectors, rng.normal(size=n), 1 + rng.random(n), rng.normal(size=(n, 3)), rng.normal(size=3), rng.normal(size=3), 0.3, 1.7)

    def plain(text):
        v = [unit[b] for b in buckets(text)]
        mean = [sum(x[d] for x in v) / max(1, len(v)) for d in range(p.dim)]
        spread = [math.sqrt(max(0, sum(x[d] ** 2 for x in v) / max(1, len(v)) - mean[d] ** 2)) for d in range(p.dim)]
        x = [(f - m) / s for f, m, s in zip([*mean, *spread, length(mean), math.log1p(len(v))], model.mean, model.scale)]
        hidden = [math.tanh(sum(x[k] * model.w1[k][j] for k in range(n)) + model.b1[j]) for j in range(3)]
        return 1 / (1 + math.exp(-(sum(h * w for h, w in zip(hidden, model.w2)) + model.b2) / model.temperature))

    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    got = sorted(((r["doc_id"], r["score"]) for r in quality_net.score(docs, model).collect()), key=key)
    want = sorted(((i, plain(t)) for i, t in rows), key=key)
    assert [a[0] for a in got] == [a[0] for a in want]
    assert np.allclose([a[1] for a in got], [a[1] for a in want], atol=1e-4)


@pytest.mark.parametrize("labelled", [False, True])
def test_pipeline_of_odd_rows(spark, tmp_path, labelled):
    """Null ids and texts, repeats, long texts, clashing columns and empty tables, through all stages."""
    schema = "doc_id long, quality int, toxic int"
    for name, rows in (("odd", TEXTS + near_copies()), ("none", [])):
        labels = [(i, int(k % 3 > 0), int(k % 5 == 0)) for k, (i, _) in enumerate(rows)] if labelled else []
        docs = odd_docs(spark, rows)
        docs = docs.select(*(F.col(c).cast("string" if t == "void" else t).alias(c) for c, t in docs.dtypes))
        sf = f"{tmp_path}/{name}"
        docs.repartition(3).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([*labels, (None, 1, None)], schema).write.parquet(f"{sf}/labels.parquet")
        docs = read_table(spark, sf, "documents")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf).schema == docs.schema
        packed = corpus_pipeline.run(spark, sf).collect()
        assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
        if not rows:
            assert not packed
        elif labelled:
            assert {r["doc_id"] for r in packed} <= {i for i, _ in rows}
        else:  # nothing is known against any row, so one of each group and all rows without words are packed
            groups = {g for g, (_, t) in zip(brute(rows)[1], rows) if gram_set(t)}
            firsts = [r for r in packed if r["piece"] == 0]
            assert len(firsts) == len(groups) + sum(not gram_set(t) for _, t in rows)


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "n-gram Jaccard join", "best-fit packing"]
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    good = corpus_pipeline.quality(spark, docs, SMALL)
    assert good.schema == docs.schema
    judged = {r["doc_id"]: r["predicted"] for r in quality_net.score(docs, quality_net.fit(docs, labels)).collect()}
    assert {r["doc_id"] for r in good.collect()} == {k for k, v in judged.items() if v}
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert kept.schema == docs.schema and kept.count() == len(set(brute(rows)[1]))
    packed = corpus_pipeline.run(spark, SMALL)
    ids = {r["doc_id"] for r in packed.collect()}
    assert 100 < len(ids) <= good.count() and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{k}" for k in range(1, 14)] and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)
