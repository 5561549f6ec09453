"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash-random key; documents are dealt to ranges of that key within their source (the key is
uniform, so its leading digits are exact ranges and nothing has to be sampled), distributed prefix sums of the
sizes give each document its place on its source's line of words, and the line is cut at the source's exact
budget, going round again where the budget exceeds the source.

Cases: null text has size 0; a null source is a source of its own, ordered last; sources without words get
target 0 and take nothing; repeated rows are taken like any other rows; ties in the key are ordered by doc_id
and size (rows equal in both may swap places); an empty table gives an empty mix. Working columns are only added
to a narrow copy, so columns of any name may be present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import cumulative
from ..session import cut_lineage
from .text import SPACE, WORD, table, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
KEY_DIGITS = 3  # hex digits of the key that name its range: 4096 ranges in each source


def mix_key(doc_id: Column, seed: str) -> Column:
    """The hash-random key: 32 hex digits that depend on the document and the seed alone."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("|" + seed)))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
            share: float = 1.0) -> DataFrame:
    """source, source_size, target for sized rows (source, size).

    Sources in code-point order (null last) weigh ``weights`` in turn.  Together they get ``share`` of all words; no
    target exceeds ``max_epochs`` times its source.  A source is at its cap exactly if the common level that fills
    the total reaches cap / weight; that is decided in whole numbers from prefix sums over the sources in the order
    of cap / weight, so any number of sources is handled without gathering them."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = sums.select("source", "source_size", F.col("source").isNull().alias("_last"), F.lit(1).cast("long").alias("_one"))
    ranked = cumulative(sums, [], ["_last", "source"], ["_one"], prefix="_rank")
    turn = (F.col("_rank_one") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (turn + 1).cast("int"))
    ranked = ranked.select("source", "source_size", weight.alias("_w"),
                           (F.col("source_size") * max_epochs).alias("_cap"), F.col("_rank_one").alias("_i"))
    ranked = ranked.withColumn("_ratio", F.col("_cap") / F.col("_w"))
    line = cut_lineage(cumulative(ranked, [], ["_ratio", "_i"], ["_cap", "_w"], prefix="_to"))
    total, all_w = line.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
    total = total if share == 1 else int(total * share)
    capped = (F.col("_to_cap") * F.col("_w") + F.col("_cap") * (F.lit(all_w) - F.col("_to_w"))) <= F.lit(total) * F.col("_w")
    line = line.withColumn("_capped", capped)
    used, used_w = line.where("_capped").agg(F.coalesce(F.sum("_cap"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
    level = (total - used) / (all_w - used_w) if all_w > used_w else 0.0
    return line.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap").cast("double"))
                       .otherwise(F.lit(float(level)) * F.col("_w")).alias("target"))


def take(docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
         share: float = 1.0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how many words of each document the mix takes."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        mix_key(F.col("doc_id"), seed).alias("_key"))
    sized = cut_lineage(sized.withColumn("_range", F.substring("_key", 1, KEY_DIGITS)))
    goals = targets(sized, weights, max_epochs, share)
    ranges = sized.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("_source"), F.col("_range").alias("_r"),
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    goals = goals.select(F.col("source").alias("_s"), "source_size", "target")
    ranges = ranges.join(goals, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    inside = (Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(ranges, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r")))
    budget = F.floor(F.col("target") + 0.5)
    place = F.col("_before") + F.col("_inside")
    rounds = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size")).otherwise(0)
    rest = budget - rounds * F.col("source_size")
    part = F.least(F.greatest(rest - place, F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (rounds * F.col("size") + part).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: each document once for every whole time it is taken, and
    once more, cut after its last taken word, if the cut of its source's line falls inside it.

    Rows are matched by doc_id and size, so repeated rows are taken alike; documents without words are dropped."""
    plan = take(docs, **options)
    plan = plan.where("taken > 0").groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_size")).agg(
        F.max("taken").alias("_taken"))
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    held = held.select("_doc", F.col("_doc.doc_id").alias("_own"), word_count(F.col("_doc.text")).alias("_words"))
    joined = held.join(plan, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_words") == F.col("_size")))
    copies = F.ceil(F.col("_taken") / F.col("_size")).cast("int")
    rows = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    here = F.least(F.col("_taken") - (F.col("_copy") - 1) * F.col("_size"), F.col("_size")).cast("int")
    text = F.col("_doc.text")
    pieces = F.regexp_extract_all(text, F.lit(f"{SPACE}*{WORD}"), F.lit(0))
    cut = F.when(here < F.col("_size"), F.array_join(F.slice(pieces, F.lit(1), here), "")).otherwise(text)
    return rows.select(*[(cut if c == "text" else F.col("_doc")[c]).alias(c) for c in docs.columns])


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """Words of every document that the mix of all sources takes."""
    return take(table(spark, sf_dir, "documents"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|mix') AS k
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS i
  FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap, i FROM src),
line AS (
  SELECT *, sum(cap) OVER o AS cap_to, sum(w) OVER o AS w_to, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w
  FROM weighed WINDOW o AS (ORDER BY cap / w, i ROWS UNBOUNDED PRECEDING)),
marked AS (SELECT *, cap_to * w + cap * (all_w - w_to) <= total * w AS capped FROM line),
lev AS (
  SELECT CAST(any_value(total) - coalesce(sum(cap) FILTER (capped), 0) AS DOUBLE)
         / nullif(CAST(any_value(all_w) - coalesce(sum(w) FILTER (capped), 0) AS DOUBLE), 0) AS level FROM marked),
goal AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE level * w END AS target FROM marked, lev),
placed AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM sized),
cutting AS (
  SELECT p.doc_id, p.source, p.size, g.source_size, g.target, p.place, CAST(floor(g.target + 0.5) AS BIGINT) AS budget
  FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + least(greatest(budget % source_size - place, 0), size) END AS BIGINT) AS taken
FROM cutting
"""
