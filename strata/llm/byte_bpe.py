"""Byte-level BPE encoding as a monoid tree reduction, and decoding.

*Text level.* A text is halved until its parts are small; a part is split by the pattern and every match is
encoded. Before white space that follows anything else, a match always ends and the next starts afresh,
whatever stands around, so such a place is a *cut*: the ids on both sides are independent. Two neighbours are
joined by encoding again the window from the last cut before their border to the first cut after it; the
window grows until it finds both.

*Match level.* A long match is halved too. A sequence of tokens is the encoding of its bytes if and only if
every two neighbouring tokens, encoded together, give themselves. So neighbours are joined by merging again a
window of tokens around the border, doubled until the tokens just outside it fit its first and last.

Decoding concatenates the tokens' bytes up the same kind of tree. No tokenizer is trained; the rank file's
path is a parameter and the merges are our own, checked against an independent encoder in the tests.

Defined results: a null text is empty and has no ids; repeated rows are encoded each; ids and decoded bytes
are little-endian unsigned 32-bit integers and raw bytes; columns other than ``doc_id`` and ``text`` are not
read. Memories of matches and of token pairs are bounded, and cleared when full.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import column_bytes, in_arrow, remembered


@dataclass(frozen=True)
class Params:
    ranks: str | None = None  # a rank file; by default the public byte BPE of 50,256 ids
    pattern: str | None = None
    leaf_chars: int = 1 << 15
    leaf_bytes: int = 48
    remembered: int = 250_000
    batch_bytes: int = 4 << 20


class Coder(dict):
    """match -> its ids as bytes; a dict, so that frequent matches cost one lookup."""

    def __init__(self, p: Params):
        import public_tokenizers
        import regex

        self.p = p
        self.pattern = regex.compile(p.pattern or public_tokenizers.PATTERN)
        self.gap = regex.compile(r"\S(?=\s)")
        with open(p.ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for token, r in self.rank.items():
            self.bytes_of[r] = token
        self.single = [bytes([b]) for b in range(256)]
        self.fitting: dict[tuple[bytes, bytes], bool] = {}

    # -- one match -------------------------------------------------------------------------------------------
    def merged(self, piece: bytes) -> list[bytes]:
        """Plain merging, lowest rank first, leftmost among equals."""
        parts, get, none = [self.single[b] for b in piece], self.rank.get, 1 << 60
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def fits(self, a: bytes, b: bytes) -> bool:
        found = self.fitting.get((a, b))
        if found is None:
            if len(self.fitting) > self.p.remembered:
                self.fitting.clear()
            found = self.fitting[a, b] = self.merged(a + b) == [a, b]
        return found

    def joined(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        i, j = min(1, len(left)), min(1, len(right))
        while True:
            window = self.merged(b"".join(left[len(left) - i :] + right[:j]))
            fits_left = i == len(left) or self.fits(left[-i - 1], window[0])
            fits_right = j == len(right) or self.fits(window[-1], right[j])
            if fits_left and fits_right:
                return left[: len(left) - i] + window + right[j:]
            i, j = (i if fits_left else min(2 * i, len(left))), (j if fits_right else min(2 * j, len(right)))

    def tree(self, piece: bytes) -> list[bytes]:
        if len(piece) <= self.p.leaf_bytes:
            return self.merged(piece)
        half = len(piece) // 2
        return self.joined(self.tree(piece[:half]), self.tree(piece[half:]))

    def __missing__(self, match: str) -> bytes:
        piece = match.encode()
        whole = self.rank.get(piece)
        ids = [whole] if whole is not None else [self.rank[t] for t in self.tree(piece)]
        out = np.array(ids, "<u4").tobytes()
        if len(match) <= 64:
            if len(self) > self.p.remembered:
                self.clear()
            self[match] = out
        return out

    # -- whole texts -----------------------------------------------------------------------------------------
    def flat(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def cut_before(self, text: str, lo: int, at: int) -> int:
        """The last cut in (lo, at], or lo."""
        reach = 64
        while True:
            start = max(lo, at - reach)
            last = None
            for last in self.gap.finditer(text, start, min(at + 1, len(text))):
                pass
            if last or start == lo:
                return last.end() if last else lo
            reach *= 4

    def cut_after(self, text: str, at: int, hi: int) -> int:
        """The first cut in [at, hi), or hi."""
        found = self.gap.search(text, max(0, at - 1), hi)
        return found.end() if found else hi

    def encode(self, text: str, lo: int = 0, hi: int | None = None) -> bytes:
        hi = len(text) if hi is None else hi
        if hi - lo <= self.p.leaf_chars:
            return self.flat(text[lo:hi])
        at = (lo + hi) // 2
        left, right = self.encode(text, lo, at), self.encode(text, at, hi)
        a, b = self.cut_before(text, lo, at), self.cut_after(text, at, hi)
        if a == at or b == at:
            return left + right
        return left[: len(left) - len(self.flat(text[a:at]))] + self.flat(text[a:b]) + right[len(self.flat(text[at:b])) :]

    def decode(self, ids: bytes) -> bytes:
        if len(ids) <= 1 << 18:
            return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


def round_trip(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, ids, decoded (binary): each text's encoding and what it decodes to; one row per input row."""

    memory = f"byte bpe {p}"

    def run(batches):
        coder = remembered(memory, lambda: Coder(p))
        for batch in batches:
            texts = column_bytes(batch, "text")
            lo = 0
            while lo < len(texts):
                ids, decoded, size, hi = [], [], 0, lo
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= p.batch_bytes):
                    size += len(texts[hi])
                    ids.append(coder.encode(texts[hi].decode("utf-8", "replace")))
                    decoded.append(coder.decode(ids[-1]))
                    hi += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])
                lo = hi

    rows = docs.select("doc_id", "text")
    return in_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary", keeps=memory)
