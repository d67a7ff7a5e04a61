"""Best-fit packing of token sequences, certified by dual-feasible-function lower bounds.

Documents become token ids and a closing id 0; only those longer than a sequence are cut. Pieces are dealt
evenly over partitions of about ``items`` pieces and each is packed by best-fit decreasing. A partition whose
sequence count equals its lower bound is certified optimal and done. The others exchange: the documents of
their sequences with room are dealt, whole sequences at a time, over fewer partitions and packed again, which
is kept if it saves a sequence. After ``rounds`` exchanges, or when no partition has a gap, the packing stands.
Certified partitions keep their last, partly filled sequences, so the count can exceed the bound over all pieces
by about one sequence a partition, and by more where ``rounds`` ends with partitions open; the README has figures.

Tokenising goes by words between ASCII white space, which neither the tokenizer's pattern nor its special tokens
span. A block's words are looked up all at once: words of up to 16 bytes are two numbers and a length, compared
whole with those in a table of fixed size, and the ids found are gathered by numpy. Only words that are not in
the table reach the tokenizer.

Defined results: a null or empty text is its closing id alone; repeated rows are packed each; null ids are
kept; columns other than ``doc_id`` and ``text`` are not read; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, Block, blocks, column_bytes, in_arrow, mix, remembered, runs, settled

_WORD = (~SPACE).astype(np.uint8)


@dataclass(frozen=True)
class Params:
    capacity: int = 2048
    tokenizer: str | None = None  # a file; by default the public word BPE of 49,408 ids
    items: int = 50_000
    rounds: int = 3
    table_log2: int = 20  # places of the table of words
    ids: int = 1 << 23  # that the table holds before it starts anew
    remembered: int = 100_000  # letter runs, and long words, of each of two generations


_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Remembered:
    """Texts and their ids in two generations: a full one becomes the older, what is used again moves to the new."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, keys: list[bytes], make) -> dict[bytes, bytes]:
        """The ids of ``keys``; those not known are made together."""
        found = {}
        for k in keys:
            ids = self.new.get(k) or self.old.get(k)
            if ids is not None:
                found[k] = ids
        unknown = [k for k in keys if k not in found]
        found.update(zip(unknown, make(unknown), strict=True))
        if len(self.new) > self.limit:
            self.new, self.old = {}, self.new
        self.new.update(found)
        return found


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    A new word of letters followed by other signs is two matches of the tokenizer's pattern, so both are looked up
    apart; new letter runs are encoded many at a time, and the tokens that end a match tell them apart again.
    """

    LETTERS = re.compile(rb"([A-Za-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, p: Params):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(p.tokenizer or public_tokenizers.path("word_bpe_49k.json"))
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.p, self.letters, self.long, self.signs = p, Remembered(p.remembered), Remembered(p.remembered), {b"": b""}
        self.clear()

    def clear(self) -> None:
        """An empty table: the two numbers and the length of the word at each place, and where its ids lie."""
        places = 1 << self.p.table_log2
        self.first, self.second = np.zeros(places, np.uint64), np.zeros(places, np.uint64)
        self.size = np.zeros(places, np.int8)  # 0: no word
        self.at, self.count = np.zeros(places, np.int64), np.zeros(places, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def ids(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def of_letters(self, new: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for lo in range(0, len(new), 1024):
            some = new[lo : lo + 1024]
            packed = self.ids(b" ".join(some))
            ends = np.flatnonzero(self.ends[np.frombuffer(packed, "<u4")]) * 4 + 4
            if len(ends) == len(some):
                at = [0, *ends.tolist()]
                out += [packed[a:b] for a, b in zip(at, at[1:])]
            else:
                out += map(self.ids, some)
        return out

    def of_words(self, new: list[bytes]) -> list[bytes]:
        """Ids of different words, by the tokenizer."""
        if len(self.signs) > self.p.remembered:
            self.signs = {b"": b""}
        split = []
        for w in new:
            if w.isalpha():  # ASCII letters only
                split.append((w.lower(), b""))
                continue
            m = self.LETTERS.fullmatch(w)
            letters, signs = m.groups() if m else (b"", b"")
            if not m or not (letters.isascii() or unicodedata.normalize("NFC", letters.decode("utf-8", "replace")).lower().isalpha()):
                split.append(None)
                continue
            split.append((letters.lower() if letters.isascii() else letters, signs))
            if signs not in self.signs:
                self.signs[signs] = self.ids(signs)
        known = self.letters.get(list(dict.fromkeys(x[0] for x in split if x)), self.of_letters)
        return [self.ids(w) if x is None else known[x[0]] + self.signs[x[1]] for w, x in zip(new, split, strict=True)]

    def block(self, block: Block) -> list[bytes]:
        """The ids of each part of a block."""
        starts, ends = runs(_WORD[block.buf])
        size = ends - starts
        padded = np.concatenate((block.buf, np.zeros(16, np.uint8)))
        eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
        short = size <= 16
        first = eights[starts] & _MASK[np.minimum(size, 8)]
        second = eights[np.minimum(starts + 8, len(block.buf))] & _MASK[np.clip(size - 8, 0, 8)]
        place = (mix(first + second * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)) >> np.uint64(64 - self.p.table_log2)).astype(np.int64)
        known = short & (self.size[place] == size) & (self.first[place] == first) & (self.second[place] == second)
        at, count = self.at[place], self.count[place]
        if not known.all():
            data = block.buf.tobytes()
            other = np.flatnonzero(~known)
            words = [data[a:b] for a, b in zip(starts[other].tolist(), ends[other].tolist(), strict=True)]
            new = {w: None for w in words}
            few, many = [w for w in new if len(w) <= 16], [w for w in new if len(w) > 16]
            long = self.long.get(many, self.of_words)
            ids = self.of_words(few) + [long[w] for w in many]
            if self.used > self.p.ids:
                # the ids of known words move to the front of a fresh pool
                kept = self.gathered(at[known], count[known])
                self.clear()
                self.add(kept)
                moved = np.cumsum(count[known])
                at[known] = moved - count[known]
            length = np.array([len(x) for x in ids], np.int64) // 4
            place_of = self.used + np.cumsum(length) - length
            self.add(np.frombuffer(b"".join(ids), "<u4"))
            index = {w: i for i, w in enumerate(few + many)}
            which = np.array([index[w] for w in words], np.int64)
            at[other], count[other] = place_of[which], length[which]
            learn = other[short[other]]
            spot = place[learn]
            self.first[spot], self.second[spot], self.size[spot] = first[learn], second[learn], size[learn]
            self.at[spot], self.count[spot] = at[learn], count[learn]
            # of words that meet at one place the last stays, in all columns alike
        every = self.gathered(at, count).astype("<u4").tobytes()
        upto = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(starts, np.append(block.starts, len(block.buf)))] * 4
        return [every[a:b] for a, b in zip(upto.tolist(), upto[1:].tolist())]

    def add(self, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), np.uint32)))
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def gathered(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The stretches of the pool one after the other."""
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.repeat(at - (ends - count), count) + np.arange(total)]

    def many(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text in order; no more than a block and a text are held."""
        parts: list[bytes] = []
        now = 0
        for block in blocks(texts):
            for owner, ids in zip(block.owner.tolist(), self.block(block), strict=True):
                if owner != now:
                    yield b"".join(parts)
                    parts, now = [], owner
                parts.append(ids)
        if texts:
            yield b"".join(parts)

    def __call__(self, text: bytes) -> bytes:
        return next(self.many([text]))


def pieces(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and an even ``spread`` of numbers."""

    memory = f"word ids {p}"

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, spread = remembered(memory, lambda: Encoder(p)), TaskContext.get().partitionId()
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode.many(column_bytes(batch, "text"))):
                ids += b"\0\0\0\0"
                step = 4 * p.capacity
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    row.append(i)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            where = np.arange(spread, spread + len(row))
            spread += len(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(where, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "spread"],
            )

    rows = docs.select("doc_id", "text")
    return in_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, spread long", keeps=memory)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, given in falling order, and the number of bins.

    A bit per amount of room says whether a bin has it; the lowest set bit at or above a length is its best fit.
    """
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = room[free].pop()
            if not room[free]:
                mask ^= 1 << free
        else:
            free, b = capacity, bins
            bins += 1
        where[i], offset[i] = b, capacity - free
        left = free - size
        if left:
            room[left].append(b)
            mask |= 1 << left
    return where, offset, bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound of two families of dual feasible functions over the histogram of lengths.

    One rounds lengths above ``capacity - e`` up to a whole bin and drops those below ``e``, for every e; the
    other rounds ``(k+1) * length / capacity`` down to whole k-ths, for k up to 16.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    number, total = np.cumsum(count), np.cumsum(count * size)
    e = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - e]
    below = np.where(e > 0, total[np.maximum(e - 1, 0)], 0)
    best = int(np.max(-(-(large * capacity + total[capacity - e] - below) // capacity)))
    for k in range(1, 17):
        exact = (k + 1) * size % capacity == 0
        value = np.where(exact, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, int(-(-int((count * value).sum()) // (k * capacity))))
    return best


def pack(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified: one row per piece."""
    rows = settled(pieces(docs, p))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, certified boolean, open boolean"
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"]

    def packer(number: int):
        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            table = table.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
            lengths = table["length"].to_numpy()
            where, offset, bins = best_fit(lengths, p.capacity)
            bound = lower_bound(lengths, p.capacity)
            ids = (number << 56) + (key[0].as_py() << 28) + where
            if number and len(np.unique(old := table["sequence_id"].to_numpy())) <= bins:
                ids, offset = old, table["offset"].to_numpy()  # no sequence saved
                _, where = np.unique(old, return_inverse=True)
                bins = int(where.max()) + 1
            full = np.bincount(where, lengths, bins)[where] == p.capacity
            done = np.full(len(lengths), bins == bound)
            out = {c: table[c] for c in columns[:5]}
            return pa.table(out | {"sequence_id": ids, "offset": offset, "certified": done | full, "open": ~(done | full)})

        return run

    parts = max(1, -(-rows.count() // p.items))
    dealt = rows.withColumn("part", F.pmod("spread", F.lit(parts).cast("long"))).drop("spread")
    state = settled(dealt.groupBy("part").applyInArrow(packer(0), schema))
    closed = []
    for number in range(1, p.rounds + 1):
        left = state.where("open").count() if parts > 1 else 0
        if not left:
            break
        closed.append(state.where("not open"))
        parts = max(1, min(-(-left // p.items), parts // 2))
        again = state.where("open").drop("open", "certified").withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(number)), F.lit(parts).cast("long")))
        state = settled(again.groupBy("part").applyInArrow(packer(number), schema))
    for x in closed:
        state = state.unionByName(x)
    return state.select(*columns)
