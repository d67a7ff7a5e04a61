"""Stratified shards, conversation repair and collocations against plain versions and their SQL."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from odd import CLASH, LONG, TEXTS, empty_docs, odd_docs
from pyspark.sql import functions as F

from strata.llm import interleave, phrases, queries, repair

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_interleave", "op12_repair", "op13_phrases"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


# -- shards ------------------------------------------------------------------------------------------------------
def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def plain_shards(rows, p):
    """(id, text, source) rows with shard and slot, by sorting in one place."""
    by = defaultdict(list)
    for doc_id, text, source in rows:
        stratum = "" if source is None else "=" + source
        by[stratum].append((md5(f"{p.seed}:{'' if doc_id is None else doc_id}:{md5(text or '')}"), doc_id, text, source))
    order = []
    for stratum, held in by.items():
        offset = int(md5(f"{p.seed}|{stratum}")[:8], 16) / 2**32
        for r, x in enumerate(sorted(held, key=lambda x: x[0])):
            order.append(((r + offset) / len(held), stratum, r, x))
    n = len(order)
    out = []
    for place, (_, _, _, (_, doc_id, text, source)) in enumerate(sorted(order, key=lambda x: x[:3])):
        shard = place * p.shards // n
        out.append((doc_id, text, source, shard, place - -(-shard * n // p.shards)))
    return out


@pytest.mark.parametrize("p", [interleave.Params(shards=7, cell=3, block=2), interleave.Params(), interleave.Params(shards=3, cell=1, block=1)])
def test_shards_equal_a_plain_sort(spark, p):
    rows = [(i, t, (None, "", "a", "=", "hot")[min(k % 7, 4)]) for k, (i, t) in enumerate(TEXTS * 3)]
    rows += [(900, "the same row", "hot")] * 150 + [(k, f"text {k}", f"s{k % 40}") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", F.lit(1).alias("slot"), F.lit("x").alias("cell"), F.lit(2).alias("row")).repartition(5)
    got = interleave.shards(docs, p)
    assert got.columns == ["doc_id", "text", "source", "cell", "row", "shard", "slot"]
    # rows with equal ids and contents may change places
    assert sorted((r["doc_id"] or -1, r["text"] or "", r["source"] or "", r["shard"], r["slot"]) for r in got.collect()) == sorted((i or -1, t or "", s or "", a, b) for i, t, s, a, b in plain_shards(rows, p))
    again = interleave.shards(docs.coalesce(1), p).collect()
    assert Counter(map(repr, got.collect())) == Counter(map(repr, again))


def test_shards_hold_the_mixture(spark):
    rows = [(k, f"t{k}", "hot" if k % 3 == 0 else f"s{k % 17}") for k in range(6000)]
    p = interleave.Params(shards=11, cell=50)
    got = interleave.shards(spark.createDataFrame(rows, "doc_id long, text string, source string"), p).groupBy("shard", "source").count().collect()
    whole, held = Counter(r[2] for r in rows), Counter()
    for r in got:
        held[r["shard"]] += r["count"]
        assert abs(r["count"] - whole[r["source"]] / p.shards) <= 2 + 2 * len(whole) * whole[r["source"]] / len(rows)
    assert len(got) == p.shards * len(whole)
    assert max(held.values()) - min(held.values()) <= 1 and sum(held.values()) == len(rows)


def test_shards_of_whole_rows_are_written_in_order(spark, tmp_path):
    docs = odd_docs(spark, TEXTS * 4).withColumn("source", F.lit("s"))
    interleave.write(docs, str(tmp_path / "out"), interleave.Params(shards=4, cell=5))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4 * len(TEXTS) and set(CLASH) <= set(back.columns)
    for shard in range(4):
        slots = sorted(r["slot"] for r in back.where(F.col("shard") == shard).select("slot").collect())
        assert slots == list(range(len(slots)))
    assert interleave.shards(empty_docs(spark).withColumn("source", F.lit(None).cast("string"))).count() == 0


# -- conversations -----------------------------------------------------------------------------------------------
SPACE = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """Counts, cost, audit and repaired lines of ordered (role, text) rows, by trying every string of edits."""
    seen, faults = set(), []
    for role, text in rows:
        fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    ways = []

    def extend(i, cost, audit, lines):
        def inserts(follow):
            for extra in ([], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
                follow(cost + 3 * len(extra), audit + "I" * len(extra), lines + [(r, "") for r in extra])

        def end(c, a, x):
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in x)):
                ways.append((c, a, x))

        def row(c, a, x):
            role, text = rows[i]
            extend(i + 1, c + 4, a + "D", x)
            if faults[i] not in ("blank", "duplicate"):
                c += 3 * (faults[i] == "truncated")
                extend(i + 1, c, a + "K", [*x, (role, text)])
                for r in ("user", "assistant"):
                    extend(i + 1, c + 3, a + "R", [*x, (r, text)])

        inserts(end if i == len(rows) else row)

    extend(0, 0, "", [])
    cost, audit, lines = min(ways, key=lambda w: w[:2])
    pairs = [a[:1] + b[:1] for (a, _), (b, _) in itertools.pairwise(rows)]
    count = Counter(faults)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return count["blank"], count["duplicate"], count["truncated"], sum(x not in ("su", "ua", "au") for x in pairs), cost, audit, digest, lines


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3])
def test_repair_equals_all_strings_of_edits(modulus):
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "user", "tool", ""]), rng.choice(["Yes.", "No!", "cut off", "cut", " ", "", "Why?"])) for _ in range(rng.randint(0, 4))]
        talk = repair.Conversation(repair.Params(nodes=5, modulus=modulus))
        for k, (role, text) in enumerate(rows):
            talk.add(k, role, text)
        got = talk.result()
        assert (*got[1:7], got[8]) == plain_repair(rows)[:7]


def plain_audit(rows, p):
    """Cost and audit by comparing whole strings."""
    ways = {0: (0, "")}

    def better(x, s, w):
        if s not in x or w < x[s]:
            x[s] = w
            return True

    def closed(x):
        x, go = dict(x), True
        while go:
            go = any([better(x, 3 if s == 2 else 2, (c + p.insert, a + "I")) for s, (c, a) in list(x.items())])
        return x

    for role, stays, extra in rows:
        new = {}
        for s, (c, a) in closed(ways).items():
            better(new, s, (c + p.delete, a + "D"))
            if stays:
                to = repair._NEXT.get(role, {}).get(s)
                if to is not None:
                    better(new, to, (c + extra, a + "K"))
                better(new, 3 if s == 2 else 2, (c + p.rerole + extra, a + "R"))
        ways = new
    return min(w for s, w in closed(ways).items() if s in (0, 3))


@pytest.mark.parametrize("p", [repair.Params(nodes=20), repair.Params(), repair.Params(nodes=50, modulus=5)])
def test_long_conversations_with_many_ties(p):
    rng = random.Random(8)
    for roles in ("u", "ua", "sua", "a", "uuuua"):
        talk, rows = repair.Conversation(p), []
        for k in range(400):
            role, cut = rng.choice(roles), rng.random() < 0.2
            talk.add(k, {"u": "user", "a": "assistant", "s": "system"}[role], f"{k}" if cut else f"{k}.")
            rows.append((role, True, 3 * cut))
        got = talk.result()
        assert (got[5], got[6]) == plain_audit(rows, p)
        assert len(got[7]) == len(got[6])


ODD_TALK = [
    (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 3, "assistant", None), (1, None, None, "What?"), (1, 2, "assistant", LONG),
    (2, None, None, None), (None, 1, "user", "A null id."), (None, 2, "assistant", "Another."), (3, 5, "", "No role."), (4, 1, "user", "\x85   é"),
]


def test_odd_conversations_and_repaired_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    convs = spark.createDataFrame(ODD_TALK, schema).select("*", *(F.lit("x").alias(c) for c in ("audit", "made", "dropped", "row", "place", "edit")))
    got = {r["conv_id"]: r for r in repair.audits(convs.repartition(4)).collect()}
    lines = defaultdict(list)
    for r in sorted(repair.repaired(convs).collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert set(got) == {1, 2, 3, 4, None}
    for conv in got:
        rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in ODD_TALK if c == conv))
        want = plain_repair([(r, x) for _, _, r, x in rows])
        have = got[conv]
        assert (have["blank"], have["duplicate"], have["truncated"], have["illegal"], have["cost"], have["audit"], have["repaired_sha256"]) == want[:7]
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == want[6]
    assert got[1]["gaps"] == 1 and got[2]["gaps"] == 0
    gone = repair.audits(convs, F.lit(True)).collect()
    assert len(gone) == 5 and {(r["cost"], r["audit"], r["repaired_sha256"]) for r in gone} == {(0, "", hashlib.sha256(b"").hexdigest())}
    nothing = spark.createDataFrame([], schema)
    assert repair.audits(repair.damaged(nothing), F.col("dropped")).count() == repair.repaired(nothing).count() == 0


def test_damage_reaches_every_kind(spark):
    talk = spark.createDataFrame([(c, t, "assistant", "One. Two!") for c in range(40) for t in range(6)] + [(None, None, None, None)], "conv_id long, turn long, role string, text string")
    rows = repair.damaged(talk)
    kinds = Counter((r["dropped"], r["role"], r["text"]) for r in rows.collect())
    assert kinds[(True, "assistant", "One. Two!")] and kinds[(False, "assistant", "")] and kinds[(False, "assistant", "One Two")] and kinds[(False, "user", "One. Two!")]
    assert max(r["count"] for r in rows.where("conv_id IS NOT NULL").groupBy("conv_id", "turn").count().collect()) == 2
    assert {r["conv_id"] for r in repair.audits(rows, F.col("dropped")).collect()} == {*range(40), None}


# -- phrases -----------------------------------------------------------------------------------------------------
def plain_collocations(docs, p):
    count, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, p.longest + 1):
                count.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    rows = defaultdict(list)
    frequent = {g: a for g, a in count.items() if a >= p.least}
    for g, a in frequent.items():
        lang, words = g[0], g[1:]
        if len(words) < 2:
            continue
        score, _, l, r = min((2000000 * a // (count[(lang, *words[:k])] + count[(lang, *words[k:])]), k, count[(lang, *words[:k])], count[(lang, *words[k:])]) for k in range(1, len(words)))
        inside = any(
            h[0] == lang and len(h) > len(g) and 100 * b >= p.inside * a and any(h[1 + i : 1 + i + len(words)] == words for i in range(len(h) - len(words)))
            for h, b in frequent.items()
        )
        if not inside:
            rows[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, k + 1, w.decode(), -a, l, r, total[lang], -s) for lang, held in rows.items() for k, (s, a, w, l, r) in enumerate(sorted(held)[: p.top]))


WORDS = ["red", "Red", "ÉTÉ", "été", "a", "b", "c d", "x\ty", "日本", "\x85", "q r", ".", ",", "\r\n", "!", "x" * 30, "o\x1cp"]


@pytest.mark.parametrize(
    "p",
    [phrases.Params(least=4), phrases.Params(least=3, block=40, top=7, held=50, phrases=10, bucket=100), phrases.Params(least=3, bits=5, field_log2=3, block=200), phrases.Params(least=2, bits=9, field_log2=9, longest=2), phrases.Params(least=5, inside=40)],
)
def test_collocations_equal_plain_counts(spark, p):
    rng = random.Random(2)
    docs = [(k, None if k == 3 else " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 40))), rng.choice([None, "en", "de", ""])) for k in range(40)]
    docs += [(None, "red a b red a b.", "en")] * 5 + [(7, LONG, "de"), (8, "", None)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").select("*", *(F.lit(1).alias(c) for c in ("n", "a", "phrase", "print", "c"))).repartition(3)
    got = phrases.collocations(table, p)
    assert sorted(tuple(r)[:8] for r in got.collect()) == plain_collocations([d[1:] for d in docs], p)
    texts = defaultdict(list)
    for i, text, _ in docs:
        texts[i].append((text or "").encode())
    for r in got.where("first_doc IS NOT NULL").collect():  # the pointer leads to the phrase
        word = r["phrase"].split(" ")[0].encode()
        assert any(np.frombuffer(t, np.uint8)[r["first_start"] :].tobytes().lower().startswith(word.lower()) for t in texts[r["first_doc"]])
    assert phrases.collocations(table.limit(0), p).count() == 0


def test_packed_fingerprints_come_back():
    rng = np.random.default_rng(4)
    for n, log2 in ((0, 3), (1, 0), (5000, 6), (300, 20)):
        prints, number = phrases.summed([rng.integers(0, 1 << 64, n, np.uint64) >> np.uint64(24) << np.uint64(24)] * 2, [rng.integers(1, 1 << 31, n)] * 2)
        got = list(phrases.pack(prints, number, log2))
        assert [b for b, _ in got] == sorted({int(x) >> (64 - log2) for x in prints})
        back = [unpacked for _, data in got for unpacked in zip(*phrases.unpack(data), strict=True)]
        assert back == list(zip(prints >> np.uint64(24), number, strict=True))


def test_numbers_beyond_64_bits(spark):
    sql = "(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"
    a, l, r = 9_000_000_000_000_000_001, 9_000_000_000_000_000_007, 9_100_000_000_000_000_003
    assert spark.sql(f"SELECT {sql} AS s FROM VALUES ({a}L, {l}L, {r}L) t(a, l, r)").first()["s"] == 2000000 * a // (l + r)
