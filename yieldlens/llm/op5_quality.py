"""Quality rules from cross-document line frequency (DataFrame functions only).

Lines are normalised (ASCII white space collapsed, lower case, digits folded) and hashed; for every host (the
document's source) the number of distinct documents with the line is counted, exact copies of a document counting
once.  A line in more documents of its host than the limit is boilerplate and is removed from the texts that
``keep`` hands on; a document that keeps less than ``min_left`` of its words is depleted and rejected, as are documents that fail the base rules.

Cases: null or empty text has no words and fails the base rules; a null source is a host of its own; repeated rows
are exact copies and count once; a text of any length is handled in its own row; extra columns are ignored.  All
per-document work is array functions in the row: nothing but one narrow row for each distinct line is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import BROADCAST_ROWS, SPACE, WORD, table

MIN_WORDS = 50
MAX_REPEAT_SHARE = 50  # per cent of words in repeated three-word windows
LINE_DOCS = 20         # a line of up to so many documents of a host is never boilerplate
LINE_SHARE = 0.02      # nor is a line of up to this share of the host's documents
MIN_LEFT = 0.2         # share of its words that a document must keep


def repeated_words(words: Column) -> Column:
    """Words of an array that lie in a three-word window found twice or more.

    Window hashes are sorted as plain longs; only documents with two equal hashes go on to find the positions."""
    n = F.size(words)
    last = F.greatest(n - 2, F.lit(0))
    hashes = F.transform(F.slice(words, F.lit(1), last), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def positions(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(pairs, lambda s: F.sort_array(F.array_compact(F.transform(s, lambda p, k: F.when(
            (p["h"] == F.get(s, k - 1)["h"]) | (p["h"] == F.get(s, k + 1)["h"]), p["i"])))))

    def covered(p: Column) -> Column:
        return F.aggregate(
            p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")),
            lambda s, i: F.struct((s["n"] + F.least(i - s["at"], F.lit(3))).alias("n"), i.alias("at")),
            lambda s: s["n"])

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
        _let(h, lambda g: _let(positions(g), covered))))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_key(line: Column) -> Column:
    """Hash of a normalised line."""
    flat = F.trim(F.regexp_replace(line, F.lit(SPACE + "+"), F.lit(" ")))
    return F.xxhash64(F.regexp_replace(F.lower(flat), F.lit("[0-9]+"), F.lit("0")))


def measures(docs: DataFrame) -> DataFrame:
    """One row for each document: its id, host, a hash of the text, the base figures and its lines as
    (hash, words) pairs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    pairs = F.transform(raw, lambda line: F.struct(line_key(line).alias("h"),
                                                   F.regexp_count(line, F.lit(WORD)).alias("n")))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return docs.select(
        "doc_id", F.col("source").alias("host"), content_key(F.col("text")).alias("content"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(raw) - F.size(F.array_distinct(raw))).cast("long").alias("n_dup_lines"),
        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                       repeated_words(w).alias("n_repeat_words"))).alias("w"),
        pairs.alias("lines"),
    ).select("doc_id", "host", "content", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
             "lines")


def boilerplate(lines: DataFrame, min_docs: int = LINE_DOCS, share: float = LINE_SHARE) -> DataFrame:
    """host, h of the lines above the limit; ``lines`` has host, content and the distinct line hashes hs.

    Copies are folded by one shuffle on (host, content) before the count, so a line's count is of distinct
    documents; the count itself is combined on the map side, so a line that a third of all documents share
    arrives as one row from each task."""
    texts = lines.groupBy("host", "content").agg(F.first("hs").alias("hs"))
    n = texts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).select(F.col("host").alias("_host"), "n")
    freq = texts.select("host", F.explode("hs").alias("h")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs"))
    return (freq.where(F.col("docs") > min_docs).join(n, F.col("host").eqNullSafe(F.col("_host")))
            .where(F.col("docs") > share * F.col("n")).select("host", "h"))


def content_key(text: Column) -> Column:
    """A hash that names the text of a document."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text, F.length(text))


def judge(docs: DataFrame, min_docs: int = LINE_DOCS, share: float = LINE_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """doc_id, host, content, the base figures, base_failed, left_words, kept and cut (the keys of the document's
    boilerplate lines, or null) for every document."""
    m = measures(docs).withColumn("_row", F.monotonically_increasing_id())
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))
    stored = cut_lineage(m.withColumn("base_failed", base))
    common = boilerplate(stored.select("host", "content", F.array_distinct(F.col("lines.h")).alias("hs")), min_docs, share)
    common = common.select(F.col("host").alias("_host"), F.col("h").alias("_h"))
    each = stored.select("_row", "host", F.explode("lines").alias("line")).select("_row", "host", "line.h", "line.n")
    gone = each.join(common, F.col("host").eqNullSafe(F.col("_host")) & (F.col("h") == F.col("_h")))
    gone = gone.groupBy(F.col("_row").alias("_r")).agg(F.sum("n").alias("_gone"), F.collect_set("h").alias("cut"))  # of one document
    out = stored.drop("lines").join(gone, F.col("_row") == F.col("_r"), "left")
    left = F.col("n_words") - F.coalesce(F.col("_gone"), F.lit(0))
    out = out.withColumn("left_words", left.cast("long"))
    return out.select("doc_id", "host", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "left_words", (~F.col("base_failed") & (F.col("left_words") >= min_left * F.col("n_words"))).alias("kept"), "cut")


def keep(docs: DataFrame, **limits) -> DataFrame:
    """The documents that the rules keep, their texts without the boilerplate lines (n_chars, where there is one, counted
    anew for texts that lost lines)."""
    marks = judge(docs, **limits).where("not kept or cut is not null")
    marks = cut_lineage(marks.select("doc_id", "host", "content", "kept", "cut").dropDuplicates(["doc_id", "host", "content"]))
    size = marks.agg(F.sum(F.when(F.col("cut").isNull(), 1).otherwise(1 + F.size("cut"))).alias("n")).first()["n"] or 0
    marks = marks.select(F.struct("doc_id", "host", "content", "kept", "cut").alias("_mark"))
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), content_key(F.col("text")).alias("_content"))
    same = (F.col("_doc.doc_id").eqNullSafe(F.col("_mark.doc_id")) & F.col("_doc.source").eqNullSafe(F.col("_mark.host"))
            & (F.col("_content") == F.col("_mark.content")))
    rows = held.join(F.broadcast(marks) if size <= BROADCAST_ROWS else marks, same, "left")
    rows = rows.where(F.col("_mark").isNull() | F.col("_mark.kept"))
    own = F.filter(F.split(F.col("_doc.text"), "\n"),
                   lambda line: ~line.rlike(WORD) | ~F.array_contains(F.col("_mark.cut"), line_key(line)))
    rows = rows.withColumn("_left", F.when(F.col("_mark.cut").isNotNull(), F.array_join(own, "\n")))
    out = {"text": F.coalesce("_left", "_doc.text"), "n_chars": F.when(
        F.col("_left").isNotNull(), F.length("_left")).otherwise(F.col("_doc")["n_chars"]).cast(docs.schema["n_chars"].dataType)
        if "n_chars" in docs.columns else None}
    return rows.select(*[out.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Base figures and the verdict of the line-frequency rule for every document."""
    return judge(table(spark, sf_dir, "documents")).drop("host", "content", "cut")


SQL = r"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (
  SELECT r, unnest([struct_pack(i := i, a := ws[i], b := ws[i + 1], c := ws[i + 2]) for i in range(1, len(ws) - 1)]) AS x
  FROM w WHERE len(ws) > 2),
again AS (SELECT r, x.i AS i FROM g QUALIFY count(*) OVER (PARTITION BY r, x.a, x.b, x.c) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
l AS (
  SELECT r, host, t, lower(regexp_replace(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]+', '0', 'g')) AS line,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, host, t, unnest(ls) AS x FROM w)),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
freq AS (SELECT host, line, count(DISTINCT t) AS docs FROM l GROUP BY host, line),
common AS (
  SELECT f.host, f.line FROM freq f JOIN hosts h ON f.host IS NOT DISTINCT FROM h.host
  WHERE f.docs > 20 AND f.docs > 0.02 * h.n),
gone AS (
  SELECT l.r, sum(l.n) AS n FROM l JOIN common c ON l.host IS NOT DISTINCT FROM c.host AND l.line = c.line GROUP BY l.r),
fig AS (
  SELECT w.r, w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.r = rep.r),
judged AS (
  SELECT fig.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CAST(n_words - coalesce(gone.n, 0) AS BIGINT) AS left_words
  FROM fig LEFT JOIN gone ON fig.r = gone.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, left_words,
       NOT base_failed AND left_words >= 0.2 * n_words AS kept
FROM judged
"""
