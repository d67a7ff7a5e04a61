"""Licence scan: Dice coefficient over word bigrams between normalised text and licence templates.

Normalised words are lower-cased runs of ASCII letters and digits or of other UTF-8 bytes. Every window of
neighbouring words of a text is compared, whatever lines or empty lines lie between, with every template.
With a and b bigrams, the coefficient ``2 * common / (a + b)`` can reach ``t`` only if
``t / (2 - t) <= a / b <= (2 - t) / t``. A window that begins or ends with a bigram the template lacks is worse than
the one without it, so windows run from one such bigram (a hit) to another; a start whose next ``t / (2 - t) * b``
hits do not lie within ``(2 - t) / t * b`` bigrams is passed over. Bigrams count as often as they occur.

The matches of one template are its best window, the best one beside it, and so on; the match of a template is
left out where a better one, at least as long, overlaps it.

The templates are short public notices; more can be passed as a parameter (id -> text).

Defined results: a null or empty text, like a text that matches nothing, has a null licence, dice 0 and no
matches; ties go to the longer template, then to the smaller id, then to the earlier window; repeated rows are
scanned each; columns other than ``doc_id`` and ``text`` are not read. Lines are numbered from 0.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import KIND, Block, column_bytes, cut, hashes, in_arrow, mix, runs

# The wording of public licence notices.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.""",
    "MIT-notice": "Released under the MIT License.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely.""",
    "Copyright-notice": "All rights reserved.",
}

_WORD = np.where((KIND == 1) | (KIND == 2), 1, 0).astype(np.uint8)
_FILTER = 16


@dataclass(frozen=True)
class Params:
    least: float = 0.8
    templates: dict[str, str] = field(default_factory=lambda: TEMPLATES)
    block_bytes: int = 1 << 20


def bigrams(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of neighbouring normalised words, and the positions where each begins and ends."""
    starts, ends = runs(_WORD[block.buf])
    h = hashes(block.buf, starts, ends)
    return mix(h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:]), starts[:-1], ends[1:]


class Templates:
    def __init__(self, p: Params):
        self.least = max(p.least, 1e-9)
        self.all = []
        for name, text in p.templates.items():
            b, _, _ = bigrams(Block([(0, text.lower().encode())]))
            if len(b):
                self.all.append((len(b), name, Counter(b.tolist())))
        self.all.sort(key=lambda t: (-t[0], t[1]))
        self.sorted = np.unique(np.array([x for _, _, c in self.all for x in c], np.uint64))
        self.counts = np.array([[c.get(x, 0) for x in self.sorted.tolist()] for _, _, c in self.all], np.int64).reshape(len(self.all), len(self.sorted))
        self.bounds = [(max(1, math.ceil(self.least * n / (2 - self.least) - 1e-9)), math.floor((2 - self.least) * n / self.least + 1e-9)) for n, _, _ in self.all]
        self.seen = np.zeros(1 << _FILTER, bool)
        self.seen[self.sorted >> np.uint64(64 - _FILTER)] = True

    def known(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which bigrams some template has, and their numbers: a bit field first, then the sorted hashes."""
        maybe = np.flatnonzero(self.seen[b >> np.uint64(64 - _FILTER)])
        at = np.searchsorted(self.sorted, b[maybe])
        same = self.sorted[np.minimum(at, len(self.sorted) - 1)] == b[maybe] if len(self.sorted) else np.zeros(0, bool)
        return maybe[same], at[same]

    def best_ends(self, k: int, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dice, first and last hit of the best window from every start that reaches the least coefficient.

        ``at`` and ``ids`` are the places and numbers of template ``k``'s hits in a stretch of text.
        """
        n, size, (fewest, most) = len(at), self.all[k][0], self.bounds[k]
        near = np.flatnonzero(at[fewest - 1 :] - at[: max(0, n - fewest + 1)] < most)
        if not len(near):
            return np.zeros(0), near, near
        # a hit adds to a window if the window lacks the hit that many of its kind earlier
        order = np.argsort(ids, kind="stable")
        earlier = np.arange(n) - self.counts[k][ids[order]]
        rival = np.empty(n, np.int64)
        rival[order] = np.where(earlier >= np.searchsorted(ids[order], ids[order]), order[np.maximum(earlier, 0)], -1)
        stop = np.searchsorted(at, at[near] + most)
        width = int((stop - near).max())
        out = []
        for lo in range(0, len(near), max(1, (1 << 18) // width)):
            first = near[lo : lo + max(1, (1 << 18) // width)]
            last = first[:, None] + np.arange(width)
            inside = last < stop[lo : lo + len(first), None]
            last = np.minimum(last, n - 1)
            common = np.cumsum((rival[last] < first[:, None]) & inside, axis=1)
            dice = np.where(inside, 2 * common / (at[last] - at[first][:, None] + 1 + size), 0)
            top = dice.argmax(1)
            row = np.arange(len(first))
            reach = dice[row, top] >= self.least
            out.append((dice[row, top][reach], first[reach], last[row, top][reach]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def windows(self, k: int, at: np.ndarray, ids: np.ndarray) -> list[tuple[float, int, int]]:
        """(dice, first bigram, last bigram) of windows of template ``k`` without overlap, the best ones first."""
        mine = self.counts[k][ids] > 0
        at, ids = at[mine], ids[mine]
        out, stretches = [], [(0, len(at))]
        while stretches:
            lo, hi = stretches.pop()
            dice, first, last = self.best_ends(k, at[lo:hi], ids[lo:hi])
            firsts, lasts = [], []  # of the windows taken, in order
            for x in np.lexsort((first, -dice)).tolist():
                a, z = int(first[x]), int(last[x])
                i = bisect_left(lasts, a)
                if i == len(firsts) or firsts[i] > z:
                    firsts.insert(i, a)
                    lasts.insert(i, z)
                    out.append((float(dice[x]), int(at[lo + a]), int(at[lo + z])))
            for a, z in zip([0, *(x + 1 for x in lasts)], [*firsts, hi - lo], strict=True):
                # a start between two windows whose best end lay in the second may have another
                if firsts and np.searchsorted(first, a) < np.searchsorted(first, z):
                    stretches.append((lo + a, lo + z))
        return out


def scan(text: bytes, t: Templates, block_bytes: int) -> list[tuple[float, str, int, int]]:
    """(dice, licence, first line, last line) of the matches of one text."""
    hashes_, begins, ends, line = [], [], [], 0
    pieces = list(cut(text.lower(), block_bytes))
    for k, piece in enumerate(pieces):
        # a bigram across two pieces is found by giving each piece the first word of the next
        tail = pieces[k + 1].split(None, 1)[:1] if k + 1 < len(pieces) else []
        block = Block([(0, piece + b" " + tail[0] if tail else piece)])
        b, lo, hi = bigrams(block)
        feeds = np.flatnonzero(np.frombuffer(piece, np.uint8) == 10)
        first = line + np.searchsorted(feeds, lo)
        inside = lo < len(piece)
        hashes_.append(b[inside])
        begins.append(first[inside])
        ends.append((line + np.searchsorted(feeds, hi - 1))[inside])
        line += len(feeds)
    b, begin, end = np.concatenate(hashes_), np.concatenate(begins), np.concatenate(ends)
    at, ids = t.known(b)
    if not len(at):
        return []
    often = (t.counts[:, ids] > 0).sum(1)
    found = [(d, k, lo, hi) for k in range(len(t.all)) if often[k] >= t.bounds[k][0] for d, lo, hi in t.windows(k, at, ids)]
    longest, out = np.zeros(len(b) if found else 0, np.int64), []  # of the matches over each bigram
    for d, k, lo, hi in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
        over = longest[lo : hi + 1]
        if over.max() <= hi - lo:
            np.maximum(over, hi - lo + 1, out=over)
            out.append((lo, hi, d, t.all[k][1]))
    return [(d, name, int(begin[lo]), int(end[hi])) for lo, hi, d, name in sorted(out)]


def licences(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, licence, dice, line_start, line_end, n_matches, matches: one row per input row.

    ``matches`` lists every match in the order of the text; the first five columns are the best of them.
    """

    def run(batches):
        t = Templates(p)
        size = {name: n for n, name, _ in t.all}
        schema = pa.schema([("licence", pa.string()), ("dice", pa.float64()), ("line_start", pa.int64()), ("line_end", pa.int64())])
        kind = pa.list_(pa.struct(list(schema)))
        for batch in batches:
            texts = column_bytes(batch, "text")
            every: list[list[dict]] = [[] for _ in texts]
            for i in candidates(texts, t, p):
                every[i] = [{"licence": n, "dice": d, "line_start": a, "line_end": b} for d, n, a, b in scan(texts[i], t, p.block_bytes)]
            best = [min(m, key=lambda x: (-x["dice"], -size[x["licence"]], x["licence"], x["line_start"], x["line_end"]), default={"licence": None, "dice": 0.0, "line_start": None, "line_end": None}) for m in every]
            columns = [pa.array([x[f.name] for x in best], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([len(m) for m in every], pa.int64()), pa.array(every, kind)], names=["doc_id", *schema.names, "n_matches", "matches"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_arrow(rows, run, f"doc_id {kind}, licence string, dice double, line_start long, line_end long, n_matches long, matches array<struct<licence:string,dice:double,line_start:long,line_end:long>>")


def candidates(texts: list[bytes], t: Templates, p: Params) -> list[int]:
    """The texts with a template's bigram, found over many texts at once; texts larger than a block are kept."""
    out, parts, size = [], [], 0

    def flush() -> None:
        block = Block(parts)
        b, lo, hi = bigrams(block)
        hit, _ = t.known(b)
        same = block.part_of(lo[hit]) == block.part_of(hi[hit] - 1)
        out.extend(block.owner[np.unique(block.part_of(lo[hit][same]))].tolist())

    for i, text in enumerate(texts):
        if len(text) > p.block_bytes:
            out.append(i)
            continue
        if parts and size + len(text) > p.block_bytes:
            flush()
            parts, size = [], 0
        parts.append((i, text.lower()))
        size += len(text) + 1
    if parts:
        flush()
    return out
