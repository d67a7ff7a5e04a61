"""Conversation repair: the cheapest edits that make roles alternate, found by a dynamic program over shared prefixes.

A conversation is read in the order of its turns. Each row is kept (K), given another role (R) or deleted (D),
and rows may be inserted (I), until the initials of the roles read ``(s?(ua)+)?``; of the cheapest ways the
ASCII-least string of edits counts. Per row the program holds the best way into each of four states of that
pattern. A way is a node that points at its prefix, so ways share what they have in common; a node knows its
length, a rolling hash of its letters and its ancestors at distances of powers of two. Two ways of one cost are
compared by the longest common prefix, which the ancestors find in logarithmic time; prefixes with equal hashes
that are not one node are compared letter by letter, so that a collision decides nothing.

Conversations stream: Spark deals them by id and sorts them (spilling where it must), and a task holds one row of
text at a time. The digest of the repaired text is carried along each way, as a hash state. What all ways into
the four states have in common is put aside as letters, and its nodes are given up. A conversation of any length
thus needs memory for its letters, a 16-byte digest per different row, and the nodes of the part still open.

Defined results: null roles and texts are one space; the rows of a turn are ordered by role and text, null turns
come first; a role without an initial fits nowhere and cannot be kept; rows marked as dropped only keep their
conversation in the result; rows of the null id are one conversation; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import in_arrow

_SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Params:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    cut_off: int = 3  # of a truncated row that stays
    nodes: int = 1 << 16  # after so many new ones, what is settled is put aside
    modulus: int = (1 << 61) - 1  # of the rolling hash; smaller only in tests of collisions


class Edits:
    """Strings of edits as nodes; node 0 is the empty one."""

    def __init__(self, modulus: int):
        self.modulus = modulus
        self.letter, self.made, self.depth, self.hash, self.up = [""], [""], [0], [0], [[]]

    def add(self, parent: int, letter: str, made: str) -> int:
        node = len(self.letter)
        self.letter.append(letter)
        self.made.append(made)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * 1_000_003 + ord(letter)) % self.modulus)
        up, above, k = [parent], parent, 0
        while k < len(self.up[above]):  # the ancestor at distance 2^(k+1) is 2^k above the one at 2^k
            above = self.up[above][k]
            up.append(above)
            k += 1
        self.up.append(up)
        return node

    def above(self, node: int, depth: int) -> int:
        """The prefix of a given length."""
        k = (self.depth[node] - depth).bit_length()
        while self.depth[node] > depth:
            k -= 1
            if self.depth[node] - (1 << k) >= depth:
                node = self.up[node][k]
        return node

    def same(self, a: int, b: int) -> bool:
        """Equal letters of two nodes of one depth; equal hashes are verified."""
        if a == b or self.hash[a] != self.hash[b]:
            return a == b
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        depth = min(self.depth[a], self.depth[b])
        x, y = self.above(a, depth), self.above(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        for k in range(len(self.up[x]) - 1, -1, -1):  # up to the first letters that differ
            if k < len(self.up[x]) and not self.same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.letter[x] < self.letter[y]

    def common(self, nodes: list[int]) -> int:
        """The last node that all of these have as a prefix."""
        node = nodes[0]
        for other in nodes[1:]:
            depth = min(self.depth[node], self.depth[other])
            node, other = self.above(node, depth), self.above(other, depth)
            for k in range(len(self.up[node]) - 1, -1, -1):
                if k < len(self.up[node]) and self.up[node][k] != self.up[other][k]:
                    node, other = self.up[node][k], self.up[other][k]
            if node != other:
                node = self.up[node][0]
        return node

    def read(self, node: int) -> tuple[str, str]:
        letters, made = [], []
        while node:
            letters.append(self.letter[node])
            made.append(self.made[node])
            node = self.up[node][0]
        return "".join(reversed(letters)), "".join(reversed(made))


class Way:
    """The cheapest way into a state: its cost, its edits, and the digest of what it leaves of the text."""

    __slots__ = ("cost", "node", "digest", "before", "adds")

    def __init__(self, cost: int, node: int, before: Way | None, adds: bytes | None):
        self.cost, self.node, self.before, self.adds, self.digest = cost, node, before, adds, None

    def hashed(self):
        if self.digest is None:
            self.digest = self.before.hashed() if self.before else sha256()
            if self.adds is not None:
                self.digest = self.digest.copy()
                self.digest.update(self.adds)
            self.before = self.adds = None
        return self.digest


#: States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row (0 and 3 may end).
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_MAKES = {0: ("u", 2, b"user:"), 1: ("u", 2, b"user:"), 3: ("u", 2, b"user:"), 2: ("a", 3, b"assistant:")}


class Conversation:
    """Faults, and the cheapest edits so far, of the rows added."""

    def __init__(self, p: Params):
        self.p, self.limit, self.edits, self.settled, self.settled_made = p, p.nodes, Edits(p.modulus), [], []
        self.ways: dict[int, Way] = {0: Way(0, 0, None, None)}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.initial = None
        self.seen: set[bytes] = set()

    def offer(self, ways: dict[int, Way], state: int, cost: int, before: Way, letter: str, made: str, adds: bytes | None) -> bool:
        old = ways.get(state)
        if old and old.cost < cost:
            return False
        node = self.edits.add(before.node, letter, made)
        if old and old.cost == cost and not self.edits.less(node, old.node):
            return False
        ways[state] = Way(cost, node, before, adds)
        return True

    def inserted(self) -> dict[int, Way]:
        """The ways after any insertions; two in a row at most are of use."""
        ways = dict(self.ways)
        fresh = list(ways)
        while fresh:
            again = []
            for state in fresh:
                before = ways[state]
                made, to, adds = _MAKES[state]
                if self.offer(ways, to, before.cost + self.p.insert, before, "I", made, (b"\n" if state else b"") + adds):
                    again.append(to)
            fresh = again
        return ways

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        shown, data = text.rstrip(_SPACE), text.encode("utf-8", "replace")
        name = role.encode("utf-8", "replace")
        mark = blake2b(b"%d:%b:%b" % (len(name), name, data), digest_size=16).digest()
        extra, stays = 0, False
        if not shown:
            self.blank += 1
        elif mark in self.seen:
            self.duplicate += 1
        else:
            stays = True
            if shown[-1] not in ".!?":
                self.truncated += 1
                extra = self.p.cut_off
        self.seen.add(mark)

        ways: dict[int, Way] = {}
        kept = _NEXT.get(role[:1], {})
        for state, way in self.inserted().items():
            self.offer(ways, state, way.cost + self.p.delete, way, "D", "-", None)
            if stays:
                line = b"\n" if state else b""
                if state in kept:
                    self.offer(ways, kept[state], way.cost + extra, way, "K", role[0], line + name + b":" + data)
                made, to, adds = _MAKES[state]
                self.offer(ways, to, way.cost + self.p.rerole + extra, way, "R", made, line + adds + data)
        # an end is as good as a start, and what may follow state 1 may follow state 3
        if 3 in ways:
            if 0 in ways and ways[0].cost > ways[3].cost + self.p.delete:
                del ways[0]
            if 1 in ways and ways[1].cost > ways[3].cost:
                del ways[1]
        for way in ways.values():
            way.hashed()
        self.ways = ways
        if len(self.edits.letter) > self.limit:
            self.put_aside()

    def put_aside(self) -> None:
        """Keep the letters that all ways share, and the nodes of the rest only."""
        old, fresh = self.edits, Edits(self.p.modulus)
        root = old.common([w.node for w in self.ways.values()])
        letters, made = old.read(root)
        self.settled.append(letters)
        self.settled_made.append(made)
        number = {root: 0}
        for way in self.ways.values():
            path, node = [], way.node
            while node not in number:
                path.append(node)
                node = old.up[node][0]
            for x in reversed(path):
                number[x] = fresh.add(number[old.up[x][0]], old.letter[x], old.made[x])
            way.node = number[way.node]
        self.edits = fresh
        self.limit = max(self.p.nodes, 2 * len(fresh.letter))

    def result(self) -> tuple:
        ways = self.inserted()
        best = ways[3]
        if 0 in ways and (ways[0].cost < best.cost or ways[0].cost == best.cost and self.edits.less(ways[0].node, best.node)):
            best = ways[0]
        letters, made = self.edits.read(best.node)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (
            gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost,
            "".join([*self.settled, letters]), "".join([*self.settled_made, made]), best.hashed().hexdigest(),
        )


_RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "made", "repaired_sha256")


def in_order(convs: DataFrame, dropped: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text (nulls as one space), dropped."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return convs.select("conv_id", F.col("turn").cast("long").alias("turn"), *blank, (F.lit(False) if dropped is None else dropped).alias("dropped"))


def audits(convs: DataFrame, dropped: Column | None = None, p: Params = Params()) -> DataFrame:
    """One row per conversation: its faults, the cost, the edits (``audit``) and the digest of the repaired text.

    ``made`` has for each edit the initial of the role that it leaves, ``-`` where it leaves none.
    """
    rows = in_order(convs, dropped).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        kind = now = talk = None

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in done], kind)]
            columns += [pa.array([r[k + 1] for r in done], pa.int64() if k < 6 else pa.string()) for k in range(len(_RESULT))]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_RESULT])

        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            ids = batch.column("conv_id").to_pylist()
            for k, (turn, role, text, gone) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("turn", "role", "text", "dropped")), strict=True)):
                if talk is None or ids[k] != now:
                    if talk is not None:
                        done.append((now, *talk.result()))
                    now, talk = ids[k], Conversation(p)
                if not gone:
                    talk.add(turn, role, text)
            if done:
                yield out(done)
        if talk is not None:
            yield out([(now, *talk.result())])

    kind = rows.schema["conv_id"].dataType.simpleString()
    columns = ", ".join(f"{c} {'long' if k < 6 else 'string'}" for k, c in enumerate(_RESULT))
    return in_arrow(rows, run, f"conv_id {kind}, {columns}")


def repaired(convs: DataFrame, p: Params = Params()) -> DataFrame:
    """conv_id, place, turn, role, text, edit: the rows of the repaired conversations, inserted ones without a turn."""
    known = in_order(convs).drop("dropped")
    rows = known.withColumn("row", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long"))
    edits = audits(convs, p=p).select("conv_id", "made", F.posexplode(F.split("audit", "")).alias("at", "edit")).where("edit != ''")
    so_far = Window.partitionBy("conv_id").orderBy("at")
    edits = edits.select(
        F.col("conv_id").alias("conv"), "edit", F.expr("substring(made, at + 1, 1)").alias("made"),
        F.when(F.col("edit") != "I", F.sum((F.col("edit") != "I").cast("long")).over(so_far)).alias("of_row"),
        (F.sum((F.col("edit") != "D").cast("long")).over(so_far) - 1).alias("place"),
    ).where("edit != 'D'")
    put = edits.join(rows, F.col("conv").eqNullSafe(F.col("conv_id")) & (F.col("of_row") == F.col("row")), "left")
    role = F.when(F.col("edit") == "K", F.col("role")).when(F.col("made") == "u", "user").otherwise("assistant")
    return put.select(F.col("conv").alias("conv_id"), "place", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")


def damaged(convs: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: known faults put in by the remainder of crc32(``conv_id:turn``) by 20."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    rows = in_order(convs).withColumn("fault", F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20)
    rows = rows.withColumn("dropped", F.col("fault") == 0).withColumn("again", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "dropped")


def oracle(p: Params = Params()) -> str:
    """DuckDB SQL for the query: a recursion over rows that carries whole strings."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL SELECT byte, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8
), steps AS (
  SELECT list(v ORDER BY byte) AS steps FROM bits WHERE k = 8
), marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
             lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) % 20 AS fault
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations), steps
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS again FROM marked WHERE fault <> 0)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial, rtrim(text, {space}) AS shown FROM damaged
), faults AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM numbered
), talks AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
), inserts(s, t, letters, adds) AS (
  VALUES (0, 0, '', ''), (0, 2, 'I', 'user:'), (0, 3, 'II', 'user:' || chr(10) || 'assistant:'), (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'),
         (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 2, '', ''), (2, 3, 'I', chr(10) || 'assistant:'), (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:')
), edits(s, t, letter, initial) AS (
  VALUES (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''), (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (3, 2, 'K', 'u'), (2, 3, 'K', 'a'),
         (0, 2, 'R', 'u'), (1, 2, 'R', 'u'), (3, 2, 'R', 'u'), (2, 3, 'R', 'a')
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS text FROM talks
  UNION ALL
  SELECT conv_id, i, state, cost, audit, text FROM (
    SELECT w.conv_id, f.i, e.t AS state,
           w.cost + {p.insert} * length(n.letters) + CASE e.letter WHEN 'D' THEN {p.delete} WHEN 'R' THEN {p.rerole} ELSE 0 END
             + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN {p.cut_off} ELSE 0 END AS cost,
           w.audit || n.letters || e.letter AS audit,
           w.text || n.adds || CASE WHEN e.letter = 'D' THEN '' ELSE CASE WHEN n.t = 0 THEN '' ELSE chr(10) END ||
             CASE WHEN e.letter = 'K' THEN f.role WHEN e.initial = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text END AS text
    FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN inserts n ON n.s = w.state JOIN edits e ON e.s = n.t
    WHERE e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR e.initial = f.initial)
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) = 1
), ends AS (
  SELECT w.conv_id, w.cost + {p.insert} * length(n.letters) AS cost, w.audit || n.letters AS audit, w.text || n.adds AS text
  FROM ways w JOIN talks t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.i JOIN inserts n ON n.s = w.state
  WHERE n.t IN (0, 3) QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + {p.insert} * length(n.letters), w.audit || n.letters) = 1
)
SELECT o.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate,
       coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(e.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN talks t ON t.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
