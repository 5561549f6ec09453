"""Benchmark decontamination with a positional inverted index (DataFrame functions only).

The corpus frequency of every benchmark term is counted; each benchmark window is looked up by its rarest term, and
windows of an item that share it are looked up together.  The index holds the postings (document, position, words
around) of those terms and of second terms whose lists are not much longer.  Postings less the term's offset in the item
name a diagonal of the document; the lists of both terms are intersected on it, and what is left is compared word by word
outwards from the rarest term, which gives the exact extent of all windows that occur.  With ``slop`` the lists may
differ by so many words, which gives proximity matches: each window is then looked up by the two rarest of its terms that
occur, whatever the length of their lists.

Bounds: item tables are broadcast only up to ``BROADCAST_ROWS`` rows, counted first; larger ones are joined by shuffle,
where a frequent term's postings may be split.  Nothing is made for pairs of documents.

Cases: null and empty texts have no words; an item of fewer words than a window is one window; a window with a term
that no document has is dropped at once (with ``slop``, one of whose terms less than two occur has no proximity match); repeated documents are rated alike; repeated items count once by id; an empty
table on either side gives no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .op5_quality import _let
from .text import matching, table

WINDOW = 10
WORDS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: Letters beyond ASCII that the built-in lower() would change.
OTHER_CAPITALS = r"[\x{80}-\x{10FFFF}&&[\p{IsUppercase}\p{Lt}]]"
SECOND = 4  # a second term's list is intersected if it is at most so many times as long as the first's
BROADCAST_ROWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are; the fast built-in does it where it would change nothing else."""
    return F.when(text.rlike(OTHER_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def text_words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def _small(df: DataFrame) -> DataFrame:
    """``df``, a stored table, with a broadcast hint if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame) -> DataFrame:
    """_id, _text_hash (together a document's key) and the words of each document."""
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), text_words(F.col("text")).alias("_words"))


def lookups(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: bool = False) -> DataFrame:
    """One row for each item and rarest-term place: item_id, term, j (its place), lo and hi (first and last start of
    the windows looked up by it), size (words in a window), left and right (the item's words outwards from j),
    term2 and j2 (the rarest other term that all these windows share, if its list is short enough to help, or null).
    With ``near`` there is one row for each item and places of a window's two rarest terms that occur."""
    items = benchmark.select("item_id", text_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = cut_lineage(items.distinct().withColumn("item", F.xxhash64("item_id", "words")))
    terms = cut_lineage(items.select(F.explode("words").alias("term")).distinct())
    # the outer form: the plain one would add a filter that finds all words once more
    held = _keyed(docs).select(F.explode_outer("_words").alias("term")).where("term is not null")
    freq = cut_lineage(held.join(_small(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("freq")))
    places = items.select("item", F.posexplode("words").alias("j", "term")).join(_small(freq), "term", "left")
    places = places.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("j", "freq"))).alias("places"))  # of one item
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    size = F.least(n, F.lit(window))
    rows = items.join(places, "item").withColumn("freqs", F.col("places.freq")).withColumn("size", size)
    rows = rows.withColumn("s", F.explode(starts))
    inside = F.slice("places", F.col("s") + 1, F.col("size"))
    by_freq = F.transform(F.filter(inside, lambda p: p["freq"].isNotNull()), lambda p: F.struct(p["freq"].alias("freq"), p["j"].alias("j")))
    if near:
        rows = rows.withColumn("_two", F.slice(F.array_sort(by_freq), 1, 2)).where(F.size("_two") > 0)
        rows = rows.withColumn("j", F.get("_two", F.lit(0))["j"]).withColumn("j2", F.get("_two", F.lit(1))["j"])
    else:
        rows = rows.where(~F.exists(inside, lambda p: p["freq"].isNull())).withColumn("j", F.array_min(by_freq)["j"])
    rows = rows.groupBy("item", "j", *["j2"] * near).agg(
        F.first("item_id").alias("item_id"), F.first("words").alias("words"), F.first("places").alias("places"),
        F.first("size").alias("size"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    core = F.filter(F.slice("places", F.col("hi") + 1, F.col("lo") + F.col("size") - F.col("hi")), lambda p: p["j"] != F.col("j"))
    second = F.array_min(F.transform(core, lambda p: F.struct(p["freq"].alias("freq"), p["j"].alias("j"))))
    first = F.get("places", F.col("j"))["freq"]
    reach = F.lit(window - 1)
    rows = (rows if near else rows.withColumn("j2", F.when(second["freq"] <= SECOND * first, second["j"]))).select(
        "item", "item_id", "j", "lo", "hi", "size", F.get("words", F.col("j")).alias("term"), "j2",
        F.get("words", F.col("j2")).alias("term2"), *_around("words", F.col("j"), reach))
    return cut_lineage(rows)


def _around(words: str, at: Column, reach: Column) -> tuple[Column, Column]:
    """Up to ``reach`` words to the left of a place (nearest first) and to its right."""
    begin = F.greatest(at - reach, F.lit(0))
    return (F.reverse(F.slice(words, begin + 1, at - begin)).alias("left"), F.slice(words, at + 2, reach).alias("right"))


def postings(docs: DataFrame, groups: DataFrame, window: int = WINDOW) -> DataFrame:
    """The stored index: _id, _th, term, pos, and for rarest terms the words around, outwards."""
    first = groups.select("term", F.lit(1).alias("first"))
    both = first.unionByName(groups.where("term2 is not null").select(F.col("term2").alias("term"), F.lit(0).alias("first")))
    wanted = cut_lineage(both.groupBy("term").agg(F.max("first").alias("first")))
    rows = _keyed(docs).select("_id", "_th", "_words", F.posexplode_outer("_words").alias("pos", "term"))
    rows = rows.where("term is not null").join(_small(wanted), "term")
    left, right = _around("_words", F.col("pos"), F.lit(window - 1))
    return cut_lineage(rows.select("_id", "_th", "term", "pos", F.when(F.col("first") == 1, left).alias("dleft"),
                                   F.when(F.col("first") == 1, right).alias("dright")))


def _shared(a: Column, b: Column) -> Column:
    """How many leading words two arrays share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return _let(same, lambda z: F.coalesce(F.nullif(F.array_position(z, False), F.lit(0).cast("long")) - 1, F.size(z)))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """_id, _th, item_id, kind, a, b: exact matches cover the document's words a to b (inclusive); with ``slop``,
    proximity matches too: both rarest terms at words a and b, at most so many words out of place, exact or not."""
    groups = lookups(docs, benchmark, window, slop > 0)
    index = postings(docs, groups, window)
    small = _small(groups)
    one = index.where("dleft is not null").join(small, "term").select(
        "_id", "_th", "item", "item_id", "j", "lo", "hi", "size", "left", "right", "dleft", "dright", "pos", "j2",
        (F.col("pos") - F.col("j")).alias("diagonal"))
    pairs = groups.where("term2 is not null").select("item", "j", "j2", F.col("term2").alias("term"))
    two = index.select("_id", "_th", "term", "pos").join(F.broadcast(pairs) if small is not groups else pairs, "term")
    two = two.select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), F.col("item").alias("_item2"), F.col("j").alias("_j2"),
                     F.col("j2").alias("_second2"), (F.col("pos") - F.col("j2")).alias("diagonal2"), F.col("pos").alias("pos2"))
    same = (F.col("_th") == F.col("_th2")) & F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("item") == F.col("_item2")) & (F.col("j") == F.col("_j2"))
    same = same & (F.col("j2") == F.col("_second2")) if slop else same
    met = one.where("j2 is not null").join(two, same & (F.col("diagonal") == F.col("diagonal2")), "left_semi")
    met = met.unionByName(one.where("j2 is null"))
    met = met.withColumn("l", _shared(F.col("left"), F.col("dleft"))).withColumn("r", _shared(F.col("right"), F.col("dright")))
    met = met.withColumn("sa", F.greatest(F.col("lo"), F.col("j") - F.col("l"))).withColumn(
        "sb", F.least(F.col("hi"), F.col("j") + F.col("r") - F.col("size") + 1)).where("sa <= sb")
    out = met.select("_id", "_th", "item_id", F.lit("exact").alias("kind"), (F.col("diagonal") + F.col("sa")).cast("long").alias("a"),
                     (F.col("diagonal") + F.col("sb") + F.col("size") - 1).cast("long").alias("b"))
    if slop:
        shifts = F.array(*[F.lit(d) for d in range(-slop, slop + 1)])
        near = one.join(two.withColumn("shift", F.explode(shifts)), same & (F.col("diagonal") == F.col("diagonal2") + F.col("shift")))
        out = out.unionByName(near.select("_id", "_th", "item_id", F.lit("near").alias("kind"),
                                          F.least("pos", "pos2").cast("long").alias("a"), F.greatest("pos", "pos2").cast("long").alias("b")))
    return out


def rate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    hits = matches(docs, benchmark, window).groupBy("_id", "_th").agg(
        F.array_sort(F.collect_set(F.struct("a", "b"))).alias("_spans"),  # of one document
        F.collect_set(F.col("item_id").cast("string")).alias("_items"))
    covered = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda s, x: F.struct((s["n"] + F.greatest(x["b"] + 1 - F.greatest(x["a"], s["to"]), F.lit(0))).alias("n"),
                              F.greatest(s["to"], x["b"] + 1).alias("to")),
        lambda s: s["n"])
    hits = hits.select("_id", "_th", covered.alias("_hit"), F.array_sort("_items").alias("_items"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("_own"),
                       F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("n_words"))
    rows = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_th")), "left")
    items = F.coalesce("_items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
                       F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                       (F.coalesce("_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window."""
    hit = matches(docs, benchmark, window).select("_id", "_th").distinct()
    return matching(docs, hit, {"_id": F.col("doc_id"), "_th": F.xxhash64(F.col("text"))}, "left_anti")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows that occur in every document."""
    return rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[s : s + 9], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT r, p, z.n, array_to_string(ws[p : p + z.n - 1], ' ') AS w
  FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d) q, (SELECT DISTINCT n FROM iw) z
  WHERE p + z.n - 1 <= len(ws)),
m AS (SELECT dw.r, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.w = iw.w),
h AS (SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(p, p + n)) AS pos FROM m) GROUP BY r),
it AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN it ON d.r = it.r
"""
