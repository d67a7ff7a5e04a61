"""Collocations by Rabin-Karp fingerprints: count n-grams as numbers, materialise frequent phrases only.

Prefix polynomials over the hashes of a block's words give the fingerprint of each of its n-grams by one
subtraction and one product. Counting goes level by level: an n-gram can only be frequent if the shorter ones in
it are, so a level counts what the one before let through. A task sums its fingerprints (the first 40 bits of
them) and sends them sorted, as differences, to the bucket of their first bits; a bucket merges what it gets and
returns a bit per frequent fingerprint. The field of all these bits has ``2**field_log2`` of them, whatever the
size of the corpus; a bit set by chance lets a rare n-gram be counted, and nothing is lost.

The last pass holds the survivors against the text: all occurrences of a fingerprint in a block are compared, word
by word, with the one pointed at (equal numbers of different words are told apart), and a task sends its phrases,
each once, with their words, counts and pointers to first occurrences, sorted and compressed by bucket. A bucket
sums them by their words. Counts are therefore exact, whatever collides. Single words are sent only if a frequent
pair of words has them. Scores are exact integers in decimal arithmetic.

Defined results: a null or empty text has no words, a null language is ``und``; repeated rows count each; rows
with a null id are counted and not pointed at; ids are whole numbers; columns other than ``doc_id``, ``text`` and
``lang`` are not read; an empty table gives no rows. A long text is counted in stretches that overlap by three
words, and each n-gram belongs to the stretch in which it starts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import column_bytes, hashes, in_arrow, mix, runs, settled

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_WORD = (~_BREAK).astype(np.uint8)
_WORD[[9, 32]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = re.compile(rb"[\x20\x09-\x0d]")
_AHEAD = re.compile(rb"(?:[\x20\x09-\x0d]+[^\x20\x09-\x0d]+){0,3}")
_STEP = 0xBF58476D1CE4E5B9  # odd, hence with an inverse modulo 2^64


@dataclass(frozen=True)
class Params:
    least: int = 30  # occurrences of a candidate
    longest: int = 4  # words of a candidate
    inside: int = 80  # per cent of a candidate's occurrences that a longer one must have to replace it
    top: int = 2000  # phrases reported per language
    field_log2: int = 26
    block: int = 2 << 20
    held: int = 2 << 20  # fingerprints that a task sums before it sends them
    phrases: int = 1_000_000  # and phrases
    bucket: int = 32 << 20  # bytes of text for which there is one bucket of fingerprints
    bits: int = 64  # of a fingerprint; fewer only in tests of collisions


def stretches(text: bytes, limit: int) -> Iterator[tuple[int, int, bytes]]:
    """Place in the text, bytes in which n-grams of the stretch start, and the stretch with three words more."""
    at = 0
    while len(text) - at > limit and (gap := _GAP.search(text, at + limit)):
        end = gap.start()
        yield at, end - at, text[at : _AHEAD.match(text, end).end()]
        at = end
    yield at, len(text) - at, text[at:]


class Grams:
    """The words of some stretches of text and the fingerprints of their n-grams."""

    def __init__(self, parts: list[tuple[int, int, int, bytes]], langs: np.ndarray, bits: int):
        self.row = np.array([p[0] for p in parts], np.int64)
        self.place = np.array([p[1] for p in parts], np.int64)
        self.buf = _LOWER[np.frombuffer(b"\n".join([p[3] for p in parts]) + b"\n", np.uint8)]
        self.begin = np.concatenate(([0], np.cumsum([len(p[3]) + 1 for p in parts])))[:-1]
        self.starts, self.ends = runs(_WORD[self.buf])
        self.piece = np.cumsum(_BREAK[self.buf], dtype=np.int32)[self.starts]
        self.part = np.searchsorted(self.begin, self.starts, "right") - 1
        self.own = self.starts - self.begin[self.part] < np.array([p[2] for p in parts], np.int64)[self.part]
        self.lang = langs[self.row[self.part]]
        self.drop = np.uint64(64 - bits)
        count = len(self.starts)
        self.word = hashes(self.buf, self.starts, self.ends) >> self.drop
        power, inverse = (np.full(count + 1, x, np.uint64) for x in (_STEP, pow(_STEP, -1, 1 << 64)))
        power[0] = inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.zeros(count + 1, np.uint64)
        np.cumsum(mix(self.word) * np.multiply.accumulate(power)[:count], out=self.sums[1:])

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and fingerprints of the n-grams that lie in one piece; the language is part of them."""
        count = len(self.starts) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero((self.piece[:count] == self.piece[n - 1 :]) & self.own[:count])
        return first, mix(mix(self.sums_of(first, n) + np.uint64(n)) ^ self.lang[first]) >> self.drop << self.drop

    def sums_of(self, first: np.ndarray, n: int) -> np.ndarray:
        return (self.sums[first + n] - self.sums[first]) * self.inverse[first]


def grams(batch: pa.RecordBatch, p: Params) -> Iterator[Grams]:
    """The texts of a batch in blocks of about ``p.block`` bytes."""
    langs = np.array([int.from_bytes(blake2b(x.encode("utf-8"), digest_size=8).digest()) for x in batch.column("lang").to_pylist()], np.uint64)
    parts, size = [], 0
    for i, text in enumerate(column_bytes(batch, "text")):
        for place, own, stretch in stretches(text, p.block):
            if parts and size + len(stretch) > p.block:
                yield Grams(parts, langs, p.bits)
                parts, size = [], 0
            parts.append((i, place, own, stretch))
            size += len(stretch) + 1
    if parts:
        yield Grams(parts, langs, p.bits)


def has(field: np.ndarray, prints: np.ndarray, field_log2: int) -> np.ndarray:
    slot = prints >> np.uint64(64 - field_log2)
    return (field[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def passing(g: Grams, n: int, fields: list[np.ndarray], p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams whose parts of the longest length known to the fields (below n) are all let through."""
    first, prints = g.of(n)
    k = min(n - 1, len(fields))
    if k:
        ok = np.zeros(len(g.starts) + 1, bool)
        part, of_part = g.of(k)
        ok[part] = has(fields[k - 1], of_part, p.field_log2)
        # a part that starts past the stretch's own words is judged elsewhere: let it through
        ok[:-1] |= ~g.own
        keep = np.ones(len(first), bool)
        for j in range(n - k + 1):
            keep &= ok[first + j]
        first, prints = first[keep], prints[keep]
    return first, prints


def pack(prints: np.ndarray, number: np.ndarray, buckets_log2: int) -> Iterator[tuple[int, bytes]]:
    """Sorted fingerprints and their counts by bucket: differences and counts, a plane for each byte of them.

    Most planes are nearly constant, which is what the compression of a shuffle shortens best.
    """
    short = prints >> np.uint64(24)
    where = (short >> np.uint64(40 - buckets_log2)).astype(np.int64) if buckets_log2 else np.zeros(len(short), np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1], [True]))).tolist() if len(short) else [0]
    for lo, hi in zip(cuts, cuts[1:]):
        steps = np.diff(short[lo:hi], prepend=np.uint64(0)).astype("<u8")
        planes = steps.view(np.uint8).reshape(-1, 8).T[:5]
        yield int(where[lo]), planes.tobytes() + np.minimum(number[lo:hi], (1 << 32) - 1).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(9, -1)
    steps, number = np.zeros((planes.shape[1], 8), np.uint8), np.zeros((planes.shape[1], 4), np.uint8)
    steps[:, :5], number[:] = planes[:5].T, planes[5:].T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), number.view("<u4").ravel().astype(np.int64)


def summed(prints: list[np.ndarray], number: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, and the sums of their numbers."""
    every, many = np.concatenate(prints), np.concatenate(number)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(many[order], first) if len(first) else many


def words_of_pairs(g: Grams, pairs: np.ndarray, p: Params) -> np.ndarray:
    """Fingerprints of the words that stand in a pair let through by a field."""
    first, prints = g.of(2)
    first = first[has(pairs, prints, p.field_log2)]
    used = np.zeros(len(g.starts), bool)
    used[first] = used[first + 1] = True
    return np.unique(mix(mix(g.sums_of(np.flatnonzero(used), 1) + np.uint64(1)) ^ g.lang[used]) >> g.drop << g.drop)


def level(texts: DataFrame, lengths: tuple[int, ...], fields: list[np.ndarray], buckets_log2: int, p: Params, words: bool = False) -> list[np.ndarray]:
    """The field of n-grams of these lengths with at least ``p.least`` occurrences of their fingerprint.

    With ``words`` also the field of words in pairs that ``fields`` let through.
    """
    shared = texts.sparkSession.sparkContext.broadcast(fields)
    slots = p.field_log2 - buckets_log2  # bits of the field in a bucket, as a power of two

    def run(batches):
        held: dict[int, tuple[list, list]] = {0: ([], []), 1: ([], [])}

        def sent() -> Iterator[pa.RecordBatch]:
            for kind, (prints, number) in held.items():
                if prints:
                    rows = list(pack(*summed(prints, number), buckets_log2))
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(rows), pa.int32()), pa.array([b for b, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.binary())], names=["kind", "bucket", "data"])
                    prints.clear(), number.clear()

        def add(kind: int, prints: np.ndarray, number: np.ndarray) -> None:
            held[kind][0].append(prints), held[kind][1].append(number)

        for batch in batches:
            for g in grams(batch, p):
                for n in lengths:
                    add(0, *np.unique(passing(g, n, shared.value, p)[1], return_counts=True))
                if words:
                    prints = words_of_pairs(g, shared.value[1], p)
                    add(1, prints, np.full(len(prints), p.least))
                if sum(len(x) for prints, _ in held.values() for x in prints) > p.held:
                    yield from sent()
        yield from sent()

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        got = [unpack(x) for x in table["data"].to_pylist()]
        prints, number = summed([x for x, _ in got], [x for _, x in got])
        frequent = prints[number >= p.least]
        bits = np.zeros(1 << slots, bool)
        bits[(frequent >> np.uint64(40 - p.field_log2)).astype(np.int64) & ((1 << slots) - 1)] = True
        return pa.table({"kind": [key[0].as_py()], "bucket": [key[1].as_py()], "bits": [np.packbits(bits, bitorder="little").tobytes()]}, schema=schema)

    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("bits", pa.binary())])
    sent = in_arrow(texts, run, "kind int, bucket long, data binary")
    out = [np.zeros(1 << p.field_log2 >> 3, np.uint8) for _ in range(1 + words)]
    for r in sent.groupBy("kind", "bucket").applyInArrow(merge, "kind int, bucket long, bits binary").toArrow().to_pylist():
        size = 1 << slots >> 3
        out[r["kind"]][r["bucket"] * size : (r["bucket"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def same_words(g: Grams) -> np.ndarray:
    """A number for each word, equal exactly for equal bytes."""
    _, rep, number = np.unique(g.word, return_index=True, return_inverse=True)
    size = g.ends - g.starts
    other = rep[number]
    equal = size == size[other]
    if equal.all():
        # compare the bytes of each word with those of the word it is taken for
        shift = np.repeat(g.starts[other] - g.starts, size)
        at = np.flatnonzero(_WORD[g.buf])
        if np.array_equal(g.buf[at], g.buf[at + shift]):
            return number
    data, seen = g.buf.tobytes(), {}
    return np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip(g.starts.tolist(), g.ends.tolist(), strict=True)], np.int64)


def told_apart(g: Grams, ids: np.ndarray, first: np.ndarray, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence and count of each phrase among n-grams, equal fingerprints verified by their words."""
    _, rep, number, count = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
    other = first[rep][number]
    if all(np.array_equal(ids[first + j], ids[other + j]) for j in range(n)) and np.array_equal(g.lang[first], g.lang[other]):
        return first[rep], count
    keys = np.column_stack([g.lang[first].view(np.int64), *(ids[first + j] for j in range(n))])
    _, rep, count = np.unique(keys, axis=0, return_index=True, return_counts=True)
    return first[rep], count


def planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of whole numbers, a plane for each."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    got = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((got.shape[1], 8), np.uint8)
    out[:, :width] = got.T
    return out.view("<i8").ravel()


_WIDTHS = (5, 8, 5, 1)  # of counts, ids, places, and whether there is an id


def pack_phrases(found: list[tuple[bytes, list]]) -> bytes:
    """Phrases in order with [count, id, place] of each, compressed."""
    found.sort()
    columns = [np.array(x, np.int64) for x in zip(*((c, d or 0, a or 0, d is not None) for _, (c, d, a) in found), strict=True)]
    return zlib.compress(b"".join([len(found).to_bytes(8, "little"), *map(planes, columns, _WIDTHS), b"\n".join([w for w, _ in found])]), 3)


def unpack_phrases(data: bytes) -> Iterator[tuple[bytes, int, int | None, int]]:
    data = zlib.decompress(data)
    n, at, columns = int.from_bytes(data[:8], "little"), 8, []
    for width in _WIDTHS:
        columns.append(from_planes(data[at : at + n * width], width).tolist())
        at += n * width
    for words, count, doc, start, there in zip(data[at:].split(b"\n"), *columns, strict=True):
        yield words, count, doc if there else None, start


def gather(held: dict[bytes, list], words: bytes, count: int, doc: int | None, start: int) -> None:
    """Add to the count of a phrase, and keep the pointer to its first occurrence."""
    old = held.get(words)
    if old is None:
        held[words] = [count, doc, start]
    else:
        old[0] += count
        if doc is not None and (old[1] is None or (doc, start) < (old[1], old[2])):
            old[1], old[2] = doc, start


def phrases(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """lang, n, phrase, a, first_doc, first_start: phrases with ``p.least`` occurrences or more, and their words.

    ``first_start`` counts bytes of the document's text; the row with ``n`` 0 has all words of the language.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("und")).alias("lang"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets_log2 = min(max(3, (size // p.bucket).bit_length()), 20, p.field_log2 - 3)
    once = level(texts, (1,), [], buckets_log2, p)
    pairs = level(texts, (2,), once, buckets_log2, p)
    longer, words = level(texts, tuple(range(3, p.longest + 1)), [once[0], pairs[0]], buckets_log2, p, words=True)
    shared = texts.sparkSession.sparkContext.broadcast([words, pairs[0], *[longer] * (p.longest - 2)])

    def run(batches):
        held: dict[str, dict[bytes, list]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                buckets: dict[int, list] = {}
                for item in found.items():
                    buckets.setdefault(zlib.crc32(item[0]) >> (32 - buckets_log2), []).append(item)
                found.clear()
                rows = [(b, pack_phrases(buckets.pop(b))) for b in list(buckets)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["lang", "bucket", "data"])
            held.clear()

        for batch in batches:
            lang, doc = batch.column("lang").to_pylist(), batch.column("doc_id").to_pylist()
            for name in lang:
                held.setdefault(name, {})
            for g in grams(batch, p):
                same, data, owner = same_words(g), g.buf.tobytes(), g.row[g.part]
                for n in range(1, p.longest + 1):
                    first, prints = passing(g, n, shared.value[: n - 1], p)
                    keep = has(shared.value[n - 1], prints, p.field_log2)
                    rep, number = told_apart(g, same, first[keep], prints[keep], n)
                    spans = [(g.starts[rep + j].tolist(), g.ends[rep + j].tolist()) for j in range(n)]
                    words = map(b" ".join, zip(*([data[a:b] for a, b in zip(*s, strict=True)] for s in spans), strict=True))
                    place = (g.starts[rep] - g.begin[g.part[rep]] + g.place[g.part[rep]]).tolist()
                    for row, phrase, count, start in zip(owner[rep].tolist(), words, number.tolist(), place, strict=True):
                        gather(held[lang[row]], phrase, count, doc[row], start)
                for row, count in enumerate(np.bincount(owner[g.own], minlength=1).tolist()):
                    if count:
                        gather(held[lang[row]], b"", count, doc[row], 0)
                if sum(map(len, held.values())) > p.phrases:
                    yield from sent()
                    held.update((name, {}) for name in lang)
        yield from sent()

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        every: dict[bytes, list] = {}
        for chunk in table["data"]:
            for found in unpack_phrases(chunk.as_py()):
                gather(every, *found)
        kept = [(w, x) for w, x in every.items() if x[0] >= p.least or not w]
        size = [w.count(b" ") + 1 if w else 0 for w, _ in kept]
        start = [x[2] if x[1] is not None else None for _, x in kept]
        words = pa.array([w for w, _ in kept], pa.binary())
        return pa.table([[key[0].as_py()] * len(kept), size, words, [x[0] for _, x in kept], [x[1] for _, x in kept], start], schema=schema)

    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("phrase", pa.binary()), ("a", pa.int64()), ("first_doc", pa.int64()), ("first_start", pa.int64())])
    sent = in_arrow(texts, run, "lang string, bucket long, data binary")
    found = sent.groupBy("lang", "bucket").applyInArrow(merge, "lang string, n int, phrase binary, a long, first_doc long, first_start long")
    return found.withColumn("phrase", F.decode("phrase", "utf-8"))


def collocations(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, first_doc, first_start: the first ``p.top`` phrases of each language."""
    known = settled(phrases(docs, p))
    candidates = known.where("n >= 2")
    count = known.where("n >= 1").select("lang", "phrase", "a")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    cut = cut.withColumn("rest", F.expr("substring(phrase, char_length(head) + 2)"))
    cut = cut.join(count.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cut = cut.join(count.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    scored = cut.withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"), *(F.first(c).alias(c) for c in ("a", "first_doc", "first_start")))

    longer = candidates.where("n >= 3").withColumn("words", F.split("phrase", " "))
    longer = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("n") - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)))
    longer = longer.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    apart = best.join(longer, ["lang", "phrase"], "left")
    dec = "CAST({} AS DECIMAL(19,0)) * {}"
    apart = apart.where(F.expr(f"longer IS NULL OR {dec.format('longer', 100)} < {dec.format('a', p.inside)}"))

    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase"))
    total = known.where("n = 0").select("lang", F.col("a").alias("n"))
    first = apart.withColumn("rank", place.cast("long")).where(F.col("rank") <= p.top).join(total, "lang")
    return first.select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score", "first_doc", "first_start")


def oracle(p: Params = Params()) -> str:
    """DuckDB SQL for lang, rank, phrase, a, l, r, n, score."""
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {n} AS n, array_to_string(words[i:i + {n - 1}], ' ') AS phrase FROM (SELECT lang, words, unnest(range(1, len(words) - {n - 2})) AS i FROM pieces WHERE len(words) >= {n})" for n in range(1, p.longest + 1)
    )
    return f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS words
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts)
), grams AS (
  {grams}
), f AS (
  SELECT lang, n, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {p.least}
), totals AS (
  SELECT lang, count(*) AS n FROM grams WHERE n = 1 GROUP BY lang
), candidates AS (
  SELECT lang, n, phrase, a, string_split(phrase, ' ') AS words FROM f WHERE n >= 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a) AS score
  FROM (SELECT *, unnest(range(1, n)) AS k FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), within AS (
  SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, n - size + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS size FROM candidates WHERE n >= 3))
  GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN within w ON w.lang = b.lang AND w.phrase = b.phrase
  WHERE w.longer IS NULL OR 100::HUGEINT * w.longer < {p.inside}::HUGEINT * b.a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score::BIGINT AS score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {p.top}
"""
