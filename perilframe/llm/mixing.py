"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised. The exponent is bisected to the target: the
largest exponent not above 1 at which no source repeats more than ``repetition_limit`` times as often as the least
repeated one would need, or the one whose weights have a wanted entropy. The token budget is dealt by weight; a source takes its
documents in whole passes while its budget lasts, each pass in another order of its blocks, and the last pass stops
at the budget: first at a block, then, inside the cut block, at a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.llm.common import whole_text, written

BLOCKS, SEED, STEPS = 256, "mix-1", 60
#: A source's blocks are doubled until a block of an even hash has at most so many rows of the whole corpus.
BLOCK_ROWS = 1 << 20
#: Rows of the block schedule (a few numbers each) up to which it is broadcast; beyond, it joins by shuffle.
BROADCAST_ROWS = 200_000


def _hash(*parts):
    """52 bits of an MD5, as a long; the same in every SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def tokens():
    """Words of a text: what stands between single spaces, line ends or tabs."""
    t = whole_text()
    for mark in ("\n", "\r", "\t"):
        t = F.replace(t, F.lit(mark), F.lit(" "))
    t = F.trim(t)
    gaps = F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "), F.lit("")))
    return F.when(F.octet_length(t) == 0, F.lit(0)).otherwise(gaps + 1).cast("long")


def _block(blocks: int):
    """A row's block by doc_id; rows without one by text."""
    return F.pmod(_hash(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))), F.lit(blocks)).cast("int")


def weights(sizes: DataFrame, repetition_limit: float | None = 2.0, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """(source, source_tokens, weight, source_budget) from (source, source_tokens).

    The bisection runs in one row over the array of token counts: the sources of a mixture are a recipe, not data. Without a
    ``budget`` the budget is the least that takes every document once. With one, the repetition limit holds for it: the exponent
    is the largest at which the smallest source comes at most that often, and a budget beyond ``repetition_limit`` times all
    tokens, which no exponent could keep, is cut to that. Sources without tokens have weight and budget 0.
    """
    some = sizes.where("source_tokens > 0")
    n = some.agg(F.sort_array(F.collect_list(F.col("source_tokens").cast("double"))).alias("n"))

    def shares(e):
        return F.transform("n", lambda x: F.pow(x / F.array_max("n"), e))

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)

    most = total(F.col("n")) * repetition_limit if repetition_limit is not None else F.lit(None)
    asked = None if budget is None else F.least(F.lit(float(budget)), most) if repetition_limit is not None else F.lit(float(budget))

    def high(e):  # whether the exponent has to be larger
        if entropy is not None:  # entropy falls as the exponent grows
            p = F.transform(shares(e), lambda x: x / total(shares(e)))
            return total(F.transform(p, lambda x: -x * F.log(x))) >= entropy
        if repetition_limit is None:
            return F.lit(False)
        if asked is None:
            return F.pow(F.array_min("n") / F.array_max("n"), e - 1) > repetition_limit
        return asked * F.pow(F.array_min("n") / F.array_max("n"), e) / total(shares(e)) / F.array_min("n") > repetition_limit * (1 + 1e-9)

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def step(acc, _):
        mid = (acc["lo"] + acc["hi"]) / 2
        return F.struct(F.when(high(mid), mid).otherwise(acc["lo"]).alias("lo"), F.when(high(mid), acc["hi"]).otherwise(mid).alias("hi"))

    found = n.select("n", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["hi"].alias("e"))
    whole = total(shares(F.col("e"))) * F.array_max("n") if asked is None else asked  # the largest source once, others oftener
    found = found.select("e", F.array_max("n").alias("top"), total(shares(F.col("e"))).alias("norm"), whole.alias("whole"))
    out = some.crossJoin(F.broadcast(found)).select("source", "source_tokens", (F.pow(F.col("source_tokens") / F.col("top"), F.col("e")) / F.col("norm")).alias("weight"), "whole")
    out = out.select(F.col("source").alias("_s"), "weight", F.floor(F.col("weight") * F.col("whole") + 1e-6).alias("source_budget"))
    zero = F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("source_budget", F.lit(0)).cast("long").alias("source_budget")
    return sizes.join(out, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "source_tokens", *zero)


def schedule(blocks: DataFrame, weight: DataFrame) -> DataFrame:
    """(source, block, pass, place, start, whole, left) of every block and pass.

    place: the block's rank in the pass's order; start: the source's tokens before it; whole: it fits the budget; left:
    tokens that the budget leaves it.
    """
    passes = F.explode(F.sequence(F.lit(0), F.coalesce(F.greatest(F.ceil(F.col("source_budget") / F.nullif("source_tokens", F.lit(0))) - 1, F.lit(0)), F.lit(0)).cast("int")))
    rows = blocks.join(weight, F.col("source").eqNullSafe(F.col("_source"))).withColumn("pass", passes)
    order = Window.partitionBy("source", "pass").orderBy(_hash(F.lit(SEED), F.coalesce("source", F.lit("")), F.col("pass").cast("string"), F.col("block").cast("string")), "block")
    rows = rows.withColumn("place", F.row_number().over(order) - 1).withColumn("_sum", F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("pass") * F.col("source_tokens") + F.col("_sum") - F.col("block_tokens")
    rows = rows.withColumn("start", start).withColumn("left", F.col("source_budget") - start)
    return rows.where("left > 0 OR (block_tokens = 0 AND left >= 0)").select(F.col("source").alias("_source"), F.col("block").alias("_block"), "pass", "place", "start", "source_budget", (F.col("left") >= F.col("block_tokens")).alias("whole"), "left")


def mixed(docs: DataFrame, keep: list[str] | None = None, repetition_limit: float | None = 2.0, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """Every placement of a document in the mixture: the columns ``keep``, then mix_tokens, mix_pass, mix_block, mix_place.

    mix_place (0 to 1) is the share of its source's budget that stands before the document's block: sorted by it, the mixture
    has the target weights at every stretch. A null source is a source of its own, a null text has no tokens, a null doc_id
    hashes as empty. Documents without tokens go with their block. Repeated rows are placed as often as they come.
    """
    keep, n_blocks, n_rows = keep or ["doc_id", "source"], BLOCKS, docs.count()  # of a Parquet table, read from its footers
    while n_rows > n_blocks * BLOCK_ROWS:
        n_blocks *= 2
    at = {c: f"_k{i}" for i, c in enumerate(keep)}
    rows = docs.select(*(F.col(c).alias(a) for c, a in at.items()), F.col("source"), F.col("doc_id"), tokens().alias("mix_tokens"), _block(n_blocks).alias("block"))
    blocks = docs.select("source", _block(n_blocks).alias("block"), tokens().alias("n")).groupBy("source", "block").agg(F.sum("n").alias("block_tokens"))
    sizes = blocks.groupBy("source").agg(F.sum("block_tokens").alias("source_tokens"))
    plan = schedule(blocks, weights(sizes, repetition_limit, entropy, budget).withColumnRenamed("source", "_source"))
    plan = written(plan, "mix-plan")
    side = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan
    placed = rows.join(side, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    out = [*(F.col(a).alias(c) for c, a in at.items()), "mix_tokens", F.col("pass").alias("mix_pass"), F.col("block").alias("mix_block"), F.coalesce(F.col("start") / F.nullif("source_budget", F.lit(0)), F.lit(0.0)).alias("mix_place")]
    whole = placed.where("whole").select(*out)
    order = Window.partitionBy("source", "block", "pass").orderBy(_hash(F.lit(SEED), F.lit("doc"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "doc_id", "mix_tokens")
    cut = placed.where("NOT whole").withColumn("_end", F.sum("mix_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return whole.union(cut.where("_end <= left").select(*out))


def digest(docs: DataFrame) -> DataFrame:
    """The whole mixture's placements, without texts; mix_place rounded for comparison between engines."""
    out = mixed(docs)
    return out.withColumn("mix_place", F.round("mix_place", 6)).withColumn("mix_pass", F.col("mix_pass").cast("long")).withColumn("mix_block", F.col("mix_block").cast("long"))


#: The same mixture in DuckDB.
SQL = """
WITH RECURSIVE t AS (
  SELECT doc_id, source, CASE WHEN length(w) = 0 THEN 0 ELSE length(w) - length(replace(w, ' ', '')) + 1 END AS n,
         ('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 13))::BIGINT % 256 AS block
  FROM (SELECT doc_id, source, text, trim(translate(coalesce(text, ''), chr(10) || chr(13) || chr(9), '   '), ' ') AS w FROM documents)),
b AS (SELECT source, block, CAST(sum(n) AS BIGINT) AS bt FROM t GROUP BY 1, 2),
sz AS (SELECT source, CAST(sum(bt) AS BIGINT) AS st FROM b GROUP BY 1), s AS (SELECT * FROM sz WHERE st > 0),
ends AS (SELECT CAST(min(st) AS DOUBLE) AS least, CAST(max(st) AS DOUBLE) AS top FROM s),
bisect AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL SELECT i + 1, CASE WHEN pow(least / top, (lo + hi) / 2 - 1) > 2.0 THEN (lo + hi) / 2 ELSE lo END,
                   CASE WHEN pow(least / top, (lo + hi) / 2 - 1) > 2.0 THEN hi ELSE (lo + hi) / 2 END FROM bisect, ends WHERE i < 60),
e AS (SELECT hi AS e, top FROM bisect, ends WHERE i = 60),
norm AS (SELECT sum(pow(st / top, e)) AS norm FROM s, e),
w AS (SELECT source, st, CAST(floor(pow(st / top, e) / norm * (norm * top) + 1e-6) AS BIGINT) AS budget FROM s, e, norm UNION ALL SELECT source, st, 0 FROM sz WHERE st = 0),
p AS (SELECT b.source, b.block, bt, st, budget, unnest(range(0, CASE WHEN st = 0 THEN 1 ELSE greatest(CAST(ceil(budget / st) AS BIGINT), 1) END)) AS pass FROM b JOIN w ON b.source IS NOT DISTINCT FROM w.source),
o AS (SELECT *, sum(bt) OVER (PARTITION BY source, pass ORDER BY ('0x' || substr(md5('mix-1:' || coalesce(source, '') || ':' || pass || ':' || block), 1, 13))::BIGINT, block ROWS UNBOUNDED PRECEDING) AS run FROM p),
k AS (SELECT *, pass * st + run - bt AS start, budget - (pass * st + run - bt) AS rest FROM o),
j AS (SELECT t.doc_id, t.source, t.n, k.block, k.pass, k.start, k.rest, k.bt, k.budget,
  sum(t.n) OVER (PARTITION BY t.source, k.block, k.pass ORDER BY ('0x' || substr(md5('mix-1:doc:' || coalesce(CAST(t.doc_id AS VARCHAR), '')), 1, 13))::BIGINT, t.doc_id NULLS FIRST, t.n ROWS UNBOUNDED PRECEDING) AS run
  FROM t JOIN k ON t.source IS NOT DISTINCT FROM k.source AND t.block = k.block WHERE rest > 0 OR (bt = 0 AND rest >= 0))
SELECT doc_id, source, CAST(n AS BIGINT) AS mix_tokens, pass AS mix_pass, block AS mix_block, CASE WHEN budget = 0 THEN 0.0 ELSE round(CAST(start AS DOUBLE) / budget, 6) END AS mix_place FROM j WHERE rest >= bt OR run <= rest
"""
