"""Shards by proportional stratified interleaving: every shard has the mixture of the whole, every prefix nearly so.

The rows of a source are shuffled by a seeded hash and ranked; a row's fractional rank is its rank plus a seeded
offset of its source, over the source's size. Sorted by it, sources interleave in proportion, and cuts after
equal numbers of rows give shards whose counts differ by one at most (the ``rows`` law). With S sources and N
rows, a shard holds n/shards rows of a source of n rows, give or take ``2 + 2 * S * n / N``.

Ranks come without a sort of a whole source: hashes are dealt to cells of about ``cell`` rows, cells are counted,
counts are summed up in two levels, and rows are ranked inside their cell; the same again for the order by
fractional rank. A source with a third of all rows is spread over its cells. Rows that are equal in all columns
are counted before the first shuffle and made rows again only in the cells where they end, so that a row
repeated without bound never meets in a task either.

Rows go into whatever ``content`` says of them: with the text's digest in place of the text, as the query uses
it, shuffles stay narrow; ``write`` takes whole rows.

Defined results: a null source is a source of its own, as is an empty one; null ids and texts are hashed as
empty; equal rows get neighbouring ranks, which of them is which cannot be told; texts do not stay together
where they are equal (the law is ``rows``, which groups of copies would break); columns of the input named
``shard`` or ``slot`` are replaced; maps cannot be columns, since Spark does not group by them; an empty table
gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import settled


@dataclass(frozen=True)
class Params:
    shards: int = 40
    seed: int = 17
    cell: int = 1_000  # rows that are ranked together, about
    block: int = 4_096  # cells whose counts are summed up together


def size() -> Column:
    """UTF-8 bytes of the text (null: none) and 16 of its row."""
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16


def number(digest: Column) -> Column:
    """The first 32 bits of a digest in hexadecimal digits."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def sums_before(counts: DataFrame, by: list[str], p: Params) -> DataFrame:
    """``by``, cell, held, before, whole: rows in the cells before each cell, and in all, of its ``by``."""
    counts = counts.withColumn("block", F.expr(f"cell div {p.block}"))
    ahead = Window.partitionBy(*by, "block").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(*by, "block").agg(F.sum("held").alias("in_block"))
    earlier = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*by, "block", F.coalesce(F.sum("in_block").over(earlier), F.lit(0)).alias("earlier"), F.sum("in_block").over(Window.partitionBy(*by)).alias("whole"))
    here = counts.withColumn("here", F.coalesce(F.sum("held").over(ahead), F.lit(0)))
    return here.join(blocks, [*by, "block"]).select(*by, "cell", "held", (F.col("earlier") + F.col("here")).alias("before"), "whole")


def shards(docs: DataFrame, p: Params = Params(), content: Column | None = None, source: str = "source") -> DataFrame:
    """The rows of ``docs`` with shard (from 0) and slot (gapless from 0 in each shard).

    ``content`` is hashed with the id for the shuffle; by default the digest of the text.
    """
    content = F.md5(F.coalesce("text", F.lit(""))) if content is None else content
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    parts = (F.lit(f"{p.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), content)
    stratum = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # one to one, never null
    rows = docs.select(stratum.alias("stratum"), F.md5(F.concat(*parts)).alias("order"), F.struct(*kept).alias("row"))
    classes = settled(rows.groupBy("stratum", "order", "row").agg(F.count(F.lit(1)).alias("copies")))
    total = classes.agg(F.sum("copies")).first()[0] or 0
    cells = max(1, -(-total // p.cell))

    # the rank inside the source: cells of hashes
    classes = classes.withColumn("cell", F.shiftright(number(F.col("order")) * cells, 32))
    counts = classes.groupBy("stratum", "cell").agg(F.sum("copies").alias("held"))
    inside = Window.partitionBy("stratum", "cell").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1)
    ranked = classes.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(sums_before(counts, ["stratum"], p), ["stratum", "cell"])
    ranked = ranked.select(
        "stratum", "order", "row", "copies", (F.col("before") + F.col("ahead")).alias("low"), F.col("whole").cast("double").alias("n"),
        (number(F.md5(F.concat(F.lit(f"{p.seed}|"), "stratum"))) / F.lit(float(1 << 32))).alias("offset"),
    )

    # the order by fractional rank: cells of it; copies that fill several are split between them
    def cell_of(rank: Column) -> Column:
        return F.least(F.floor((rank + F.col("offset")) / F.col("n") * cells), F.lit(cells - 1))

    high = F.col("low") + F.col("copies") - 1
    dealt = ranked.withColumn("cell", F.explode(F.sequence(cell_of(F.col("low")), cell_of(high))))
    dealt = settled(dealt).repartition("cell")
    first = F.greatest(F.col("low"), F.floor(F.col("cell") * F.col("n") / cells - F.col("offset")) - 2)
    last = F.least(high, F.ceil((F.col("cell") + 1) * F.col("n") / cells - F.col("offset")) + 2)
    single = dealt.withColumn("rank", F.explode(F.sequence(first, F.greatest(first, last))))
    single = single.where((F.col("rank") <= high) & (cell_of(F.col("rank")) == F.col("cell")))
    single = single.withColumn("fraction", (F.col("rank") + F.col("offset")) / F.col("n"))
    held = single.groupBy("cell").agg(F.count(F.lit(1)).alias("held"))
    nth = F.row_number().over(Window.partitionBy("cell").orderBy("fraction", "stratum", "rank"))
    placed = single.withColumn("nth", nth).join(sums_before(held, [], p), "cell").withColumn("place", F.col("before") + F.col("nth") - 1)
    placed = placed.withColumn("shard", F.expr(f"place * {p.shards} div whole"))
    slot = F.expr(f"place - (shard * whole + {p.shards - 1}) div {p.shards}")
    return placed.select("row.*", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def write(docs: DataFrame, path: str, p: Params = Params()) -> None:
    """Whole rows as Parquet, a folder per shard; the files of a shard follow its slots."""
    placed = shards(docs, p)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def oracle(p: Params = Params()) -> str:
    """DuckDB SQL for the query; the checksum of a text is folded over its bytes."""
    return f"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL SELECT byte, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8
), steps AS (
  SELECT list(v ORDER BY byte) AS steps FROM bits WHERE k = 8
), rows AS (
  SELECT doc_id, coalesce('=' || source, '') AS stratum, coalesce(text, '') AS text,
         md5('{p.seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents
), sums AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT text FROM rows), steps
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h) - 1 AS r, count(*) OVER (PARTITION BY stratum) AS n FROM rows
), fractions AS (
  SELECT *, (r + ('0x' || substr(md5('{p.seed}|' || stratum), 1, 8))::BIGINT / 4294967296.0::DOUBLE) / n::DOUBLE AS fraction FROM ranked
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, r) - 1 AS place, count(*) OVER () AS whole FROM fractions
), cut AS (
  SELECT *, place * {p.shards} // whole AS shard FROM placed
)
SELECT doc_id, octet_length(encode(c.text)) + 16 AS size, s.crc AS text_crc32, 'rows' AS law, shard::INT AS shard,
       place - (shard * whole + {p.shards - 1}) // {p.shards} AS slot, NULL::INT AS grown_shard
FROM cut c JOIN sums s ON s.text = c.text
"""
