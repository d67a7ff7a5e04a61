"""Byte BPE and best-fit packing against the public tokenizers."""

import base64
import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, empty_docs, odd_docs
from tokenizers import Tokenizer

from strata.llm import best_fit, byte_bpe, queries


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


CODER = byte_bpe.Coder(byte_bpe.Params(leaf_chars=24, leaf_bytes=4, remembered=50))
PIECES = st.sampled_from(["a", "the", "'s", " ", "  ", "\n", "\t", "1", "23", "!", "...", "é", "日本", "́", "\x85", "\x1c", "ing", "tion", "aaaa", " ", "''", "S", "==", "\U0001f600"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=80).map("".join))
def test_trees_encode_as_the_reference(reference, text):
    ids = CODER.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert CODER.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 1500, "the" * 900, "=" * 2001, "日本" * 300, " " * 999 + "x", "ththingtion" * 200, "x1" * 500])
def test_long_matches(reference, text):
    assert np.frombuffer(CODER.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_bpe_query(spark, reference):
    got = byte_bpe.round_trip(odd_docs(spark)).collect()
    want = [(np.array(reference.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for _, t in TEXTS]
    assert sorted((bytes(r["ids"]), bytes(r["decoded"])) for r in got) == sorted(want)
    assert byte_bpe.round_trip(empty_docs(spark)).count() == 0
    rows = {r["doc_id"]: r for r in queries.op5_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = reference.encode_ordinary(d["text"])
        assert rows[d["doc_id"]]["n_tokens"] == len(ids)
        assert rows[d["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[d["doc_id"]]["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


# -- packing -----------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def words():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


ENCODERS = [best_fit.Encoder(best_fit.Params(table_log2=t, ids=n, remembered=10)) for t, n in ((3, 30), (12, 200), (16, 1 << 20))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.sampled_from(["İ", "Σ", "ΑΣ", "ﬁ", "<|endoftext|>", "<|STARTOFTEXT|>", "<|", "Ab", "ß", "don't", "\x0b", "\x00", "sixteenletters", "a\x00 a "])), max_size=40).map("".join))
def test_word_lookup_equals_the_tokenizer(words, text):
    for encoder in ENCODERS:
        assert np.frombuffer(encoder(text.encode()), "<u4").tolist() + [0] == words(text)


def test_special_strings_are_special(words):
    assert words("hello <|endoftext|> world")[1] == 49407
    for encoder in ENCODERS:
        assert np.frombuffer(encoder(b"hello <|endoftext|> world"), "<u4").tolist() + [0] == words("hello <|endoftext|> world")


def test_many_texts_at_once(words):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("abcdeABé!.,'1"), rng.integers(1, 25))) for _ in range(300)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 200))) for _ in range(60)] + ["", " \n", "x " * 400_000, "y" * 3000]
    for encoder in ENCODERS:
        got = list(encoder.many([t.encode() for t in texts]))
        assert [np.frombuffer(x, "<u4").tolist() + [0] for x in got] == [words(t) for t in texts]


def valid(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("p", [best_fit.Params(), best_fit.Params(capacity=50, items=8, rounds=4)])
def test_packing_is_whole_and_gapless(spark, words, p):
    docs = TEXTS + [(100 + k, "some words " * (k % 23)) for k in range(60)]
    rows = best_fit.pack(odd_docs(spark, docs).repartition(3), p).collect()
    want = []
    for i, text in docs:
        ids = words(text)
        for k, at in enumerate(range(0, len(ids), p.capacity)):
            part = np.array(ids[at : at + p.capacity], "<u4")
            want.append((-1 if i is None else i, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((-1 if r[0] is None else r[0], *tuple(r)[1:5]) for r in rows) == sorted(want)
    bins = valid(rows, p.capacity)
    bound = best_fit.lower_bound(np.array([r["length"] for r in rows]), p.capacity)
    assert bound <= bins <= 1.1 * bound + 1
    assert best_fit.pack(empty_docs(spark), p).count() == 0


def fewest(sizes, capacity):
    """The least number of bins, by trying all."""
    best = len(sizes)

    def place(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(sizes):
            best = len(room)
            return
        for r in sorted(set(room)):
            if r >= sizes[k]:
                rest = list(room)
                rest.remove(r)
                place(k + 1, [*rest, r - sizes[k]])
        place(k + 1, [*room, capacity - sizes[k]])

    place(0, [])
    return best


def test_bounds_and_bins_against_all_packings():
    rng = np.random.default_rng(3)
    exact = 0
    for _ in range(150):
        sizes = np.sort(rng.integers(1, 21, rng.integers(1, 9)))[::-1]
        least = fewest(sizes.tolist(), 20)
        where, offset, bins = best_fit.best_fit(sizes, 20)
        assert best_fit.lower_bound(sizes, 20) <= least <= bins
        assert np.bincount(where, sizes).max() <= 20
        exact += best_fit.lower_bound(sizes, 20) == least
    assert exact > 120
    assert best_fit.lower_bound(np.array([11, 11, 11]), 20) == 3 and best_fit.lower_bound(np.array([7] * 5), 20) == 3


def test_exchange_never_adds_sequences(spark):
    docs = [(k, "w " * int(n)) for k, n in enumerate(np.random.default_rng(1).integers(5, 30, 200))]
    once = best_fit.pack(odd_docs(spark, docs), best_fit.Params(capacity=40, items=10, rounds=0)).collect()
    more = best_fit.pack(odd_docs(spark, docs), best_fit.Params(capacity=40, items=10, rounds=3)).collect()
    assert valid(more, 40) <= valid(once, 40)
    assert len(more) == len(once) == len(list(itertools.chain(docs)))
