"""Line-first cleaning with DataFrame and SQL functions only.

Every line with a word is judged on its own: punctuation (too many symbols or exclamation marks), navigation
(three or more bars, or a short line that no punctuation ends) and boilerplate (stock phrases). Failing lines
are removed; a document that loses more than ``1 - keep_share`` of its word characters, or keeps fewer than
``min_words`` words, is rejected, as is one that fails the base rules (too few words, or too many words in
8-word windows that occur twice).

Words are runs of characters other than the six ASCII white-space characters, lines end at line feeds. Repeated
windows are found without shuffling a word: window hashes of a text are compared inside its row, and only texts
that have a repeat sort theirs. (A 64-bit collision inside one text would count words too many; at 100,000 words
its chance is below 1e-9.)

Defined results: a null text is empty, has no words and fails; repeated rows are judged each; null ids are kept;
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stock phrases, in lower case, that mark a line as boilerplate.
PHRASES = (
    "cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "copyright", "javascript",
    "subscribe", "sign up", "log in", "click here", "read more", "lorem ipsum", "licensed under", "released under the",
)
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Params:
    symbol_percent: int = 10  # of a line's word characters, exclamation marks included
    bars: int = 3
    short_chars: int = 24
    stock_percent: int = 5  # of a line's characters that its stock phrases must make up, each counted once
    keep_percent: int = 50
    min_words: int = 20
    repeat_percent: int = 30


def words_of(text: Column) -> Column:
    bare = F.trim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def signs_of(text: Column, signs: str) -> Column:
    """What is left of a text without all other characters."""
    return F.regexp_replace(text, f"[^{signs}]+", "")


def judged_line(line: Column, boilerplate: Column, p: Params) -> Column:
    """The line, and whether it fails; ``boilerplate``: whether the text has a stock phrase at all."""
    bare = F.regexp_replace(line, r"[\x20\x09-\x0D]+", "")
    known = F.array(*(F.struct(F.lit(x).alias("phrase"), F.lit(len(x.replace(" ", ""))).alias("size")) for x in PHRASES))
    stock = F.aggregate(known, F.lit(0), lambda n, x: n + F.when(F.contains(F.lower(line), x["phrase"]), x["size"]).otherwise(0))
    stock = F.when(boilerplate, stock).otherwise(0)
    made = F.transform(F.array(F.struct(F.char_length(bare).alias("chars"), signs_of(line, SYMBOLS + "!").alias("signs"), stock.alias("stock"))), lambda s: (
        (100 * F.char_length(s["signs"]) > p.symbol_percent * s["chars"])
        | (F.char_length(signs_of(s["signs"], "|")) >= p.bars)
        | ((s["chars"] <= p.short_chars) & ~F.right(F.rtrim(line, F.lit(SPACES + "\"')]")), F.lit(1)).isin(*".!?:;,"))
        | (boilerplate & (s["stock"] > 0) & (100 * s["stock"] >= p.stock_percent * s["chars"]))
    ))[0]
    return F.struct(line.alias("line"), made.alias("fails"))


def judged(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, the base counts, clean_text, kept_chars, kept_words, base_failed, kept: one row per input row."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    stock = F.lit(False)
    for phrase in PHRASES:
        stock |= F.contains(F.lower("text"), F.lit(phrase))
    d = d.select(
        "doc_id",
        words_of(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n", -1), lambda x: F.ltrim(x, F.lit(SPACES)) != "").alias("lines"),
        F.char_length(signs_of(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        stock.alias("stock"),
    )
    # window hashes by doubling: of one word, of two, four and eight
    d = d.withColumn("h1", F.transform("w", lambda x: F.xxhash64(x)))
    for k in (1, 2, 4):
        n = F.greatest(F.size(f"h{k}") - k, F.lit(0))
        d = d.withColumn(f"h{2 * k}", F.zip_with(F.slice(f"h{k}", F.lit(1), n), F.slice(f"h{k}", F.lit(1 + k), n), lambda x, y: F.xxhash64(x, y)))
    d = d.withColumnRenamed(f"h{WINDOW}", "h")
    d = d.withColumn("twice", F.size("h") > F.size(F.array_distinct("h")))
    d = d.withColumn("judged", F.transform(F.array("stock"), lambda stock: F.transform("lines", lambda x: judged_line(x, stock, p)))[0])
    paired = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    d = d.withColumn("s", F.when(F.col("twice"), paired))
    at = lambda j: F.get("s", j)
    same = lambda j, k: at(j)["x"] == at(k)["x"]
    found = F.transform(F.sequence(F.lit(0), F.size("s") - 1), lambda j: F.when(F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)), at(j)["i"]))
    d = d.withColumn("at", F.when(F.col("twice"), F.sort_array(F.filter(found, lambda x: x.isNotNull()))))
    covered = F.aggregate(F.sequence(F.lit(1), F.size("at") - 1), F.lit(WINDOW), lambda n, j: n + F.least(F.lit(WINDOW), F.get("at", j) - F.get("at", j - 1)))
    lost = F.concat_ws("\n", F.transform(F.filter("judged", lambda s: s["fails"]), lambda s: s["line"]))
    d = d.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        word_chars(F.col("w")).alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("twice"), covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.concat_ws("\n", F.transform(F.filter("judged", lambda s: ~s["fails"]), lambda s: s["line"])).alias("clean_text"),
        words_of(lost).alias("lost"),
    )
    d = d.withColumn("kept_chars", F.col("word_chars") - word_chars(F.col("lost"))).withColumn("kept_words", F.col("n_words") - F.size("lost"))
    failed = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))
    enough = (100 * F.col("kept_chars") >= p.keep_percent * F.col("word_chars")) & (F.col("kept_words") >= p.min_words)
    return d.withColumn("base_failed", failed).withColumn("kept", ~failed & enough).drop("lost")


def oracle() -> str:
    """The query's SQL for DuckDB, written from the rules above and independent of the plan."""
    ws = r"[\x20\x09-\x0D]"
    stock = " + ".join(f"CASE WHEN contains(lower(line), '{x}') THEN {len(x.replace(' ', ''))} ELSE 0 END" for x in PHRASES)
    bare = lambda x: f"regexp_replace({x}, '{ws}', '', 'g')"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, string_split(text, chr(10)) AS all_lines FROM docs
), line_rows AS (
  SELECT rid, unnest(all_lines) AS line, unnest(range(len(all_lines))) AS pos FROM parts
), real_lines AS (
  SELECT rid, line, pos, length({bare('line')}) AS chars FROM line_rows WHERE length({bare('line')}) > 0
), line_counts AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM real_lines GROUP BY rid
), good AS (
  SELECT rid, sum(chars) AS kept_chars, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS kept_words FROM real_lines
  WHERE NOT (100 * length(regexp_replace(line, '[^#*$%&|<>!]', '', 'g')) > 10 * chars
    OR length(regexp_replace(line, '[^|]', '', 'g')) >= 3
    OR (chars <= 24 AND NOT regexp_matches(line, '[.!?:;,][\x20\x09-\x0D"'')\]]*$'))
    OR ({stock} > 0 AND 100 * ({stock}) >= 5 * chars))
  GROUP BY rid
), windows AS (
  SELECT rid, unnest(list_transform(range(1, len(w) - 6), lambda i: w[i:i + 7])) AS win, unnest(range(1, len(w) - 6)) AS pos
  FROM parts WHERE len(w) >= 8
), repeated AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, sum(least(8, coalesce(next_pos - pos, 8))) AS n_repeat_words
  FROM (SELECT rid, pos, lead(pos) OVER (PARTITION BY rid ORDER BY pos) AS next_pos FROM repeated) GROUP BY rid
), base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length({bare('text')})::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(kept_chars, 0)::BIGINT AS kept_chars, coalesce(kept_words, 0)::BIGINT AS kept_words
  FROM parts LEFT JOIN line_counts USING (rid) LEFT JOIN good USING (rid) LEFT JOIN covered USING (rid)
), failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * kept_chars >= 50 * word_chars AND kept_words >= 20 AS kept, kept_chars, kept_words
FROM failed
"""
