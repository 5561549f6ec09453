"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents and unlabelled text are used to fit; documents labelled clean count as unlabelled.

1. Document frequencies of all words (letter runs, lower-cased in A-Z) over all documents, and over the confirmed toxic ones,
   in one pass: tasks add up their words first, Spark the rest.  With the class prior pi (share of toxic rows among
   the labelled ones of the learning rows), pi * P(word | toxic) / P(word) estimates P(toxic | word).  The ``FEATURES`` words whose
   frequency among toxic documents exceeds that in the corpus most significantly (frequency times log ratio) are the inputs.
2. Linear classifiers on the presence of these words are fitted in numpy by Adam on the risk
   pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1)) with the logistic loss; where the second part falls below zero, a step goes
   the other way, so that it doesn't turn negative by over-fitting.  ``MEMBERS`` classifiers leave out a part of the sample each, by
   its hash; each takes the weight decay with the least risk on its part, and their chances are averaged.
3. Every whole text is scored from its words; nothing but the text enters a score.

Bounds: the classifiers see at most ``TRAIN_ROWS`` confirmed toxic and as many unlabelled documents, those with the smallest hashes
of their ids; the words that are chosen, their frequencies and the scores cover all documents.  Labels and texts of held-out
rows (crc32 of the id's text divisible by ``FOLDS``) are never in the sample; their texts count in the corpus frequencies only.
A task holds a piece of ``PIECE`` bytes and the distinct words of one text, however long the text.

Cases.  Null and empty texts have no words and get the chance of a text without any; a null doc_id counts as the empty text for
crc32, is thus held out, and has no label; several labels of a document: toxic if any is; null labels are none; repeated
documents are scored alike and all count.  Without any confirmed toxic document all scores are 0.  An empty table gives an empty
result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import BROADCAST_ROWS, lowered, range_sums, table, utf8, words

FOLDS = 5
FEATURES = 1024
LEAST = 3              # confirmed toxic documents that hold a word, at least
TRAIN_ROWS = 4000
MEMBERS = 3
DECAYS = (1e-4, 1e-3, 1e-2)
STEPS = 300
RATE = 0.05
PIECE = 4 << 20

#: 1 for ASCII letters and all bytes beyond ASCII.
_LETTER = np.array([b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


def document_words(data: np.ndarray, offsets: np.ndarray, piece: int = PIECE):
    """Blocks (document, word hash) of the distinct words of each document, of all documents in the end.

    The bytes are cut into pieces between words; what a piece's last document has so far is carried on, so no word of a
    document is given twice."""
    kept = (np.empty(0, np.int64), np.empty(0, np.uint64))
    a = 0
    while a < len(data):
        b = min(len(data), a + piece)
        while b < len(data) and _LETTER[data[b]] and _LETTER[data[b - 1]]:
            more = np.nonzero(~_LETTER[data[b : b + piece]])[0]
            b = b + int(more[0]) if len(more) else min(len(data), b + piece)
        text = np.where(_LETTER[data[a:b]], lowered(data[a:b]), np.uint8(32))
        first = int(np.searchsorted(offsets, a, "right")) - 1
        last = int(np.searchsorted(offsets, b, "left"))
        starts, ends, counts = words(text, np.clip(offsets[first : last + 1], a, b) - a)
        doc = first + np.repeat(np.arange(last - first), np.diff(counts))
        doc, key = np.concatenate([kept[0], doc]), np.concatenate([kept[1], range_sums(text, starts, ends)])
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
        doc, key = doc[new], key[new]
        open_ = doc == last - 1 if b < len(data) else np.zeros(len(doc), bool)
        kept = (doc[open_], key[open_])
        yield doc[~open_], key[~open_]
        a = b
    if len(kept[0]):
        yield kept


def _frequencies(batches):
    """Task function over (text, toxic): word, documents, toxic documents; added up over pieces of the task."""
    import pyarrow as pa

    def added(keys, n, p):
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        out = [np.bincount(at, np.concatenate(v), len(key)).astype(np.int64) for v in (n, p)]
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *map(pa.array, out)], names=["word", "n", "p"])

    held, size = ([], [], []), 0
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for doc, key in document_words(data, offsets):
            word, at = np.unique(key, return_inverse=True)
            for column, v in zip(held, (word, np.bincount(at, minlength=len(word)), np.bincount(at, toxic[doc], len(word)))):
                column.append(v)
            size += len(word)
            if size > PIECE:
                yield added(*held)
                held, size = ([], [], []), 0
    if size:
        yield added(*held)


def _present(keys: np.ndarray, numbers: np.ndarray):
    """Task function over (toxic, part, text): toxic, part and the numbers of the features that a text holds."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = utf8(batch.column(2))
            found = [[] for _ in range(batch.num_rows)]
            for doc, key in document_words(data, offsets):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                for d, k in zip(doc[hit].tolist(), numbers[at[hit]].tolist()):
                    found[d].append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                                             names=["toxic", "part", "features"])

    return run


def risk(scores_p: np.ndarray, scores_u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the prior-corrected risk: pi * R_p(+1), and R_u(-1) - pi * R_p(-1), which may be negative."""
    soft = lambda z: float(np.logaddexp(0, z).mean())
    return prior * soft(-scores_p), soft(scores_u) - prior * soft(scores_p)


def fit_linear(p: np.ndarray, u: np.ndarray, prior: float, decay: float, steps: int = STEPS, rate: float = RATE) -> np.ndarray:
    """Weights (the last is the offset) of a linear classifier fitted to the non-negative risk of p (toxic) and u (unlabelled)."""
    w = np.zeros(p.shape[1] + 1)
    w[-1] = math.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    up = lambda x, d: np.append(d @ x, d.sum())
    for t in range(1, steps + 1):
        sp, su = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        chance_p, chance_u = 1 / (1 + np.exp(-np.clip(sp, -40, 40))), 1 / (1 + np.exp(-np.clip(su, -40, 40)))
        negative = up(u, chance_u / len(u)) - prior * up(p, chance_p / len(p))
        if risk(sp, su, prior)[1] >= 0:
            g = prior * up(p, (chance_p - 1) / len(p)) + negative
        else:
            g = -negative
        g = g + decay * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def train(sample: list, features: int, prior: float, members: int = MEMBERS) -> np.ndarray:
    """A row of weights for each member from (toxic, part, feature numbers); member k judges its decay on part k."""
    x = np.zeros((len(sample), features))
    for i, (_, _, found) in enumerate(sample):
        x[i, found] = 1.0
    toxic, part = np.array([s[0] for s in sample]), np.array([s[1] for s in sample])
    out = []
    for k in range(members):
        held, rest = part == k, part != k
        if not (toxic & held).any() or not (~toxic & held).any() or not (toxic & rest).any() or not (~toxic & rest).any():
            held = rest = np.ones(len(sample), bool)  # too few rows to keep any back
        tried = [fit_linear(x[toxic & rest], x[~toxic & rest], prior, decay) for decay in DECAYS]
        scored = [(x[toxic & held] @ w[:-1] + w[-1], x[~toxic & held] @ w[:-1] + w[-1]) for w in tried]
        judged = [sum((a, max(0.0, b))) for a, b in (risk(sp, su, prior) for sp, su in scored)]
        out.append(tried[int(np.argmin(judged))])
    return np.array(out)


def _scores(keys: np.ndarray, weights: np.ndarray):
    """Task function over (doc_id, held_out, text): the scores."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = utf8(batch.column(2))
            total = np.tile(weights[:, -1:], (1, batch.num_rows))
            for doc, key in document_words(data, offsets) if len(keys) else ():
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                for k in range(len(weights)):
                    total[k] += np.bincount(doc[hit], weights[k][at[hit]], batch.num_rows)
            score = (1 / (1 + np.exp(-np.clip(total, -40, 40)))).mean(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], names=["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, features: int = FEATURES, rows: int = TRAIN_ROWS, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score of every document."""
    fold = lambda c: F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds
    texts = docs.select("doc_id", F.col("text").alias("_text"), (fold(F.col("doc_id")) == 0).alias("held_out"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0))
    known = cut_lineage(known.groupBy(F.col("doc_id").alias("_of")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("_label")))
    share = known.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("p")).first()
    toxic_ids = known.where("_label = 1").select("_of")
    if share["p"]:
        prior = min(max(share["p"] / share["n"], 1e-6), 0.99)
        ids = F.broadcast(toxic_ids) if share["p"] <= BROADCAST_ROWS else toxic_ids
        marked = texts.join(ids, F.col("doc_id") == F.col("_of"), "left").withColumn("_toxic", F.col("_of").isNotNull())
        chosen, totals = _choose(marked, features)
        keys = np.array([r["word"] for r in chosen], np.int64).view(np.uint64)
        order = np.argsort(keys)
        sample = _sample(marked, rows, keys[order], order) if len(keys) and totals["p"] else []
    if not share["p"] or not any(s[0] for s in sample) or all(s[0] for s in sample):
        return texts.select("doc_id", "held_out", F.lit(0.0).alias("score"))
    weights = train(sample, len(keys), prior)
    by_key = np.concatenate([weights[:, :-1][:, order], weights[:, -1:]], axis=1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "held_out", "_text").mapInArrow(
        _scores(keys[order], by_key), f"doc_id {kind}, held_out boolean, score double")


def _choose(marked: DataFrame, features: int):
    """The chosen words with their frequencies, and the numbers of documents and confirmed toxic ones."""
    totals = marked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_toxic").cast("long")).alias("p")).first()
    counts = marked.select("_text", "_toxic").mapInArrow(_frequencies, "word long, n long, p long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("p").alias("p")).where(F.col("p") >= LEAST)
    counts = cut_lineage(counts)
    own = F.col("p") / F.lit(float(totals["p"] or 1))
    all_ = F.col("n") / F.lit(float(totals["n"] or 1))
    rest = F.when(own < 1, (1 - own) * F.log((1 - own) / (1 - all_))).otherwise(F.lit(0.0))
    gain = F.lit(2.0 * (totals["p"] or 0)) * (own * F.log(own / all_) + rest)
    tested = counts.count()
    chosen = counts.where(own > all_).withColumn("gain", gain).where(F.col("gain") >= 2 * math.log(max(tested, 2)))
    return chosen.orderBy(F.desc("gain"), "word").limit(features).collect(), totals


def _sample(marked: DataFrame, rows: int, keys: np.ndarray, numbers: np.ndarray) -> list:
    """(toxic, part, feature numbers) of the sampled documents: confirmed toxic ones, and unlabelled text drawn from all
    documents, as the risk asks.  Ids are picked first, texts of these ids read after."""
    ids = marked.where(~F.col("held_out")).select("doc_id", "_toxic").distinct()
    pick = lambda t, of: of.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("_pick"), F.lit(t).alias("toxic"))
    picked = cut_lineage(pick(True, ids.where("_toxic")).unionByName(pick(False, ids)))
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(MEMBERS)).cast("int")
    held = marked.join(F.broadcast(picked), F.col("doc_id") == F.col("_pick")).select("toxic", part.alias("part"), F.col("_text"))
    found = held.mapInArrow(_present(keys, numbers), "toxic boolean, part int, features array<int>").collect()
    return sorted((r["toxic"], r["part"], sorted(r["features"])) for r in found)


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; 1 is predicted from 0.5."""
    out = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
