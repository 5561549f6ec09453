"""Personal data by weak supervision (DataFrame and SQL functions only).

Base spans (email, ip, card, phone) come from patterns; looser patterns add candidates that no base span touches.
Regex, gazetteer, context and shape labelers vote on every span; expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, and the resulting soft labels train a logistic classifier of
spans.  Candidates it accepts are added as kind ``other``; base spans stay as they are.

Positions: a text split at a pattern and the pattern's matches interleave, so the lengths of both give every match
its place in code points.  The patterns are possessive forms that find the same matches as the plain ones without
stepping back, so a run of any length costs one pass.

Bounds: vote patterns and feature rows are counted by value, at most 3**4 and 3**4 * 5 * 4 rows whatever the input.

Cases: null or empty text has no spans; repeated rows are rated alike; extra columns are ignored; without
candidates nothing is trained; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .op5_quality import _let
from .text import table

KINDS = ("email", "ip", "card", "phone", "other")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_OK = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\.|$)){4}$"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Candidates: grouped digits, and addresses written with "at" and "dot".
LOOSE = (r"(?<![0-9A-Za-z.+@])[0-9(][0-9() ./-]{5,28}[0-9](?![0-9A-Za-z@])"
         r"|[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?:(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z0-9-]{1,63})+")
#: Gazetteers of the labelers.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
CUES = r"(?i)(?:phone|tel|call|fax|mobile|mail|contact|card|visa|ssn|social security|passport|born|ip address|iban|account)\W*\w{0,12}\W*$"
NOT_CUES = r"(?i)(?:version|release|license|section|page|pages|chapter|figure|table|isbn|issn|vol|no|year|price|\$|€|v)\W*$"
CONTEXT = 40
THRESHOLD = 0.9
EM_STEPS = 200

SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def located(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as (start, end, value), positions in code points."""
    empty = F.array().cast(SPAN)

    def place(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(gaps, found, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("v")))
        return F.aggregate(
            steps, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + F.length(x["v"])).alias("at"),
                F.array_append(s["out"], F.struct(
                    (s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + F.length(x["v"])).alias("end"),
                    x["v"].alias("value"))).alias("out")),
            lambda s: s["out"])

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda found: F.when(F.size(found) == 0, empty).otherwise(place(found)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, F.lit("[^0-9]"), F.lit(""))


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the Luhn check."""
    def total(d: Column) -> Column:
        def weighed(i: Column) -> Column:
            x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            return F.when(i % 2 == 0, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x))
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda s, i: s + weighed(i))
    return _let(digits(value), total) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Base spans of each kind, failing matches dropped."""
    n = lambda s: F.length(digits(s["value"]))
    return {
        "email": located(text, EMAIL),
        "ip": F.filter(located(text, IP), lambda s: s["value"].rlike(IP_OK)),
        "card": F.filter(located(text, CARD), lambda s: (n(s) <= 19) & luhn(s["value"])),
        "phone": F.filter(located(text, PHONE), lambda s: n(s).between(8, 15)),
    }


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def votes(kind: Column, value: Column, before: Column) -> list[Column]:
    """Votes of the four labelers on a span: 1 personal, -1 not, 0 no opinion."""
    n = F.length(digits(value))
    regex = (F.when(kind != "other", 1)
             .when(value.rlike(r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|[\[(] ?at ?[\])]"), 1)
             .when(value.rlike(r"^[0-9]+(?:\.[0-9]+){1,2}$|^[0-9]+$"), -1).otherwise(0))
    gazetteer = (F.when(value.rlike(rf"(?i)[.\])] ?(?:{DOMAINS})$"), 1)
                 .when((n >= 13) & digits(value).rlike(ISSUERS) & luhn(value), 1)
                 .when(value.rlike(r"^(?:0|10|127|192\.168)\.[0-9.]+$"), -1).otherwise(0))
    context = F.when(before.rlike(CUES), 1).when(before.rlike(NOT_CUES), -1).otherwise(0)
    shape = F.when((n >= 9) | (kind == "email"), 1).when((n > 0) & (n < 7), -1).otherwise(0)
    return [v.cast("int") for v in (regex, gazetteer, context, shape)]


VOTES = ["v_regex", "v_gazetteer", "v_context", "v_shape"]


def estimate(counts: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Chance that a span with a vote pattern is personal: expectation-maximisation over pattern counts, each
    labeler having a distribution of its votes for either class (one count of smoothing for each vote)."""
    posterior = {v: 1 / (1 + math.exp(-2.0 * sum(v))) for v, _ in counts}
    for _ in range(EM_STEPS):
        share = [sum(n * (p if y else 1 - p) for (v, n), p in ((c, posterior[c[0]]) for c in counts)) + 1 for y in (0, 1)]
        given = [[{x: (sum(n * (posterior[v] if y else 1 - posterior[v]) for v, n in counts if v[k] == x) + 1) / (share[y] + 2)
                   for x in (-1, 0, 1)} for k in range(len(VOTES))] for y in (0, 1)]
        new = {}
        for v, _ in counts:
            log = [math.log(share[y]) + sum(math.log(given[y][k][x]) for k, x in enumerate(v)) for y in (0, 1)]
            new[v] = 1 / (1 + math.exp(max(-60.0, min(60.0, log[0] - log[1]))))
        moved = max(abs(new[v] - posterior[v]) for v in new)
        posterior = new
        if moved < 1e-9:
            break
    return posterior


def classify(spans: DataFrame) -> DataFrame:
    """``spans`` (kind, n_digits and votes) counted by feature row, with the classifier's ``score``."""
    rows = spans.groupBy(*VOTES, "kind", "digit_class").agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows)
    held = [(tuple(r[v] for v in VOTES), r["n"]) for r in rows.groupBy(*VOTES).agg(F.sum("n").alias("n")).collect()]
    if not held:
        return rows.withColumn("score", F.lit(0.0))
    posterior = estimate(held)
    soft = rows.sparkSession.createDataFrame([(*v, float(p)) for v, p in posterior.items()],
                                             ", ".join(f"{v} int" for v in VOTES) + ", soft double")
    flags = {f"{v}_{'up' if x > 0 else 'down'}": (F.col(v) == x).cast("double") for v in VOTES for x in (1, -1)}
    flags |= {f"k_{k}": (F.col("kind") == k).cast("double") for k in KINDS}
    flags |= {f"d_{d}": (F.col("digit_class") == d).cast("double") for d in range(4)}
    rows = VectorAssembler(inputCols=list(flags), outputCol="features").transform(rows.withColumns(flags).join(F.broadcast(soft), VOTES))
    both = rows.withColumn("label", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).withColumn(
        "weight", F.col("n") * F.when(F.col("label") == 1, F.col("soft")).otherwise(1 - F.col("soft")))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(both.where("weight > 0"))
    scored = model.transform(rows)
    return scored.select(*VOTES, "kind", "digit_class", vector_to_array("probability")[1].alias("score"))


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_other for every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = base_spans(text)
    def named(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                     s["end"].alias("end"), s["value"].alias("value")))

    tagged = F.concat(*[named(kind, spans) for kind, spans in base.items()])
    loose = named("other", located(text, LOOSE))
    rows = docs.select("doc_id", F.col("text").alias("_text"), tagged.alias("_base"), loose.alias("_loose"))
    free = F.filter("_loose", lambda c: ~F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    seen = lambda spans: F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.struct(*[v.alias(n) for n, v in zip(VOTES, votes(
            s["kind"], s["value"], F.substring(F.col("_text"), F.greatest(s["start"] - CONTEXT + 1, F.lit(1)).cast("int"),
                                               F.least(s["start"], F.lit(CONTEXT)).cast("int"))))]).alias("votes"),
        F.least(F.length(digits(s["value"])) / 5, F.lit(3)).cast("int").alias("digit_class")))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("_row"), seen(F.col("_base")).alias("_base"),
                       seen(free).alias("_other"))
    rows = cut_lineage(rows)
    each = rows.select("_row", F.explode(F.concat("_base", "_other")).alias("s")).select(
        "_row", "s.kind", "s.start", "s.end", "s.votes.*", "s.digit_class")
    rated = classify(each).select(*[F.col(c).alias("_" + c) for c in (*VOTES, "kind", "digit_class")], "score")
    same = [F.col(c) == F.col("_" + c) for c in (*VOTES, "kind", "digit_class")]
    others = each.where(F.col("kind") == "other").join(F.broadcast(rated), same).where(F.col("score") >= threshold)
    others = others.groupBy(F.col("_row").alias("_r")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_added"))  # of one document
    out = rows.join(others, F.col("_row") == F.col("_r"), "left")
    added = F.coalesce(F.col("_added"), F.array().cast("array<struct<start:bigint,end:bigint>>"))
    added = F.transform(added, lambda s: F.struct(F.lit("other").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    plain = F.transform("_base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(joined(plain).cast("binary"), 256).alias("base_sha256"),
                      joined(F.concat(plain, added)).alias("spans"), F.size(added).cast("long").alias("n_other"))


def op10_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those the span classifier adds."""
    return find(table(spark, sf_dir, "documents"))
