"""Fitted models on Spark ML, cross-fitting, calibrators and resampling estimates.

Model fits are the only actions inside operators.  Folds
and permutations come from integer hashes of the record key, so results do
not depend on partitioning.  Rank metrics reuse the distributed helpers in
``metrics``; nothing per-row reaches the driver (only fitted parameters).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite
from ..functions.expressions import r6
from ..functions.ranking import cumulative, exact_quantiles
from ..session import cut_lineage
from . import features as FE
from . import imputation as IM
from . import isotonic as IS
from . import metrics as M
from . import permutation as PM

FOLDS = 5
SEED = 42


def unit_hash(*cols: Column, salt: int = 0) -> Column:
    """Deterministic uniform [0, 1) from columns (partitioning-independent): 52 bits of a mixing hash, so that rows,
    replicates and salts give independent values."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), *[c.cast("long") for c in cols]), 12) / float(1 << 52)


def stratified_folds(df: DataFrame, k: int = FOLDS, key: str = "o_orderkey", seed: int = SEED,
                     id_col: str = "record_id") -> DataFrame:
    """Fold = (distributed rank within class by a seeded hash) mod k: class shares equal in every fold."""
    base = df.select(id_col, "target", key, ((F.col(key) * 2654435761 + seed) % 4294967296).alias("_h"),
                     F.lit(1).alias("_one"))
    r = cumulative(base, ["target"], ["_h", id_col], ["_one"])
    return r.select(id_col, "target", ((F.col("cum__one") - 1) % k).cast("int").alias("fold"))


def _prepared(wide: DataFrame, features: Sequence[str], stats: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    med = FE._stat_map(stats, "median")
    cols = [F.coalesce(finite(c), F.lit(med.get(c) or 0.0)).alias(c) for c in features]
    flags = [finite(c).isNull().cast("double").alias(f"{c}_missing") for c in features]
    return wide.select("record_id", "target", "side", *keep, *cols, *flags)


def _stored(wide: DataFrame, features: Sequence[str], *more: str) -> DataFrame:
    """The model's columns, written once: fits read their rows many times over, and must not join and group them each time."""
    return cut_lineage(wide.select("record_id", "target", "side", *more, *features))


def with_folds(ref: DataFrame, k: int = FOLDS) -> DataFrame:
    """``ref`` with its stratified ``fold``, written once."""
    return cut_lineage(ref.join(stratified_folds(ref, k).select("record_id", "fold"), "record_id"))


def estimator(kind: str, features: Sequence[str], weight_col: str | None = None):
    inputs = list(features) + [f"{c}_missing" for c in features]
    va = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    if kind == "logistic":
        clf = LogisticRegression(labelCol="target", regParam=1.0 / (0.25 * 100), elasticNetParam=0.0, maxIter=50,
                                 standardization=True, weightCol=weight_col) if weight_col else \
            LogisticRegression(labelCol="target", regParam=0.04, maxIter=50)
    elif kind == "forest":
        clf = RandomForestClassifier(labelCol="target", numTrees=100, maxDepth=8, seed=SEED, weightCol=weight_col) \
            if weight_col else RandomForestClassifier(labelCol="target", numTrees=100, maxDepth=8, seed=SEED)
    else:
        raise ValueError(kind)
    return Pipeline(stages=[va, clf])


def _with_weights(df: DataFrame) -> DataFrame:
    """Balanced class weights n / (2 n_c) from one aggregate."""
    c = df.groupBy("target").agg(F.count(F.lit(1)).alias("_nc"))
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    w = c.crossJoin(n).select("target", (F.col("_n") / (2.0 * F.col("_nc"))).alias("weight"))
    return df.join(F.broadcast(w), "target")


def _prob(scored: DataFrame) -> Column:
    return vector_to_array("probability")[1]


def fit_score(wide: DataFrame, features: Sequence[str], kind: str = "logistic", balanced: bool = True) -> DataFrame:
    """Fit on the reference side (medians fitted there too), score the current side once."""
    wide = _stored(wide, features)
    stats = FE.development_stats(wide, features, fit=F.col("side") == "reference")
    data = _prepared(wide, features, stats)
    train = data.where(F.col("side") == "reference")
    if balanced:
        train = _with_weights(train)
    model = estimator(kind, features, "weight" if balanced else None).fit(train)
    scored = model.transform(data.where(F.col("side") == "current"))
    return scored.select("record_id", "target", F.lit(kind).alias("model"), r6(_prob(scored)).alias("probability"))


def out_of_fold_scores(wide: DataFrame, features: Sequence[str], kind: str = "logistic", k: int = FOLDS) -> DataFrame:
    """Every reference row scored by the model fitted without its fold (k fits, unioned)."""
    data = with_folds(_stored(wide.where(F.col("side") == "reference"), features, "o_orderkey"), k)
    out = None
    for i in range(k):
        prep = _prepared(data, features, FE.development_stats(data.where(F.col("fold") != i), features), ["fold"])
        model = estimator(kind, features, "weight").fit(_with_weights(prep.where(F.col("fold") != i)))
        te = prep.where(F.col("fold") == i).drop("fold")
        s = model.transform(te).select("record_id", "target", F.lit(i).alias("fold"),
                                       r6(vector_to_array("probability")[1]).alias("probability"))
        out = s if out is None else out.unionByName(s)
    return out


def fold_spread(wide: DataFrame, features: Sequence[str], k: int = FOLDS) -> DataFrame:
    """Mean and spread of the k fold models' scores for each current row; all models score a row in one pass."""
    wide = _stored(wide, features, "o_orderkey")
    reference = F.col("side") == "reference"
    stats = FE.development_stats(wide, features, fit=reference)
    train = cut_lineage(_prepared(with_folds(wide.where(reference), k), features, stats, ["fold"]))
    models = [estimator("logistic", features, "weight").fit(_with_weights(train.where(F.col("fold") != i))) for i in range(k)]
    t = models[0].stages[0].transform(_prepared(wide.where(F.col("side") == "current"), features, stats)).select("record_id", "features")
    for i, model in enumerate(models):
        scorer = model.stages[1].copy().setProbabilityCol(f"_p{i}").setRawPredictionCol("").setPredictionCol("")
        t = scorer.transform(t)
    p = F.explode(F.array(*[vector_to_array(f"_p{i}")[1] for i in range(k)])).alias("p")
    return t.select("record_id", p).groupBy("record_id").agg(r6(F.avg("p")).alias("fold_mean"), r6(F.stddev_samp("p")).alias("fold_std"))


def cv_benchmark(scores: DataFrame, keys: Sequence[str] = ("model",), fold: str = "fold") -> DataFrame:
    """Per model x fold: ROC AUC, AP, Brier, recall/precision/F1 at 0.5; then mean and sample std per model."""
    kk = list(keys) + [fold]
    ranked = M.ranked_scores(scores, kk)
    auc = M.roc_auc(ranked, kk)
    ap = M.average_precision(ranked, kk)
    y, pr = F.col("target") == 1, F.col("probability") >= 0.5
    c = scores.groupBy(*kk).agg(
        F.avg(F.pow(F.col("probability") - F.col("target"), 2)).alias("brier"),
        F.count(F.when(y & pr, 1)).alias("tp"), F.count(F.when(~y & pr, 1)).alias("fp"), F.count(F.when(y & ~pr, 1)).alias("fn"))
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    f1 = F.when(rec + prec > 0, 2 * rec * prec / (rec + prec)).otherwise(0.0)
    per = c.join(auc, kk).join(ap, kk).select(*kk, "roc_auc", "average_precision", F.col("brier").alias("brier_score"),
                                              rec.alias("recall"), prec.alias("precision"), f1.alias("f1"))
    metrics = ["roc_auc", "average_precision", "brier_score", "recall", "precision", "f1"]
    long = per.unpivot(kk, metrics, "metric", "value")
    agg = long.groupBy(*keys, "metric").agg(r6(F.avg("value")).alias("mean"), r6(F.stddev_samp("value")).alias("std"),
                                            F.count(F.lit(1)).alias("folds"))
    return agg


def permutation_importance(wide: DataFrame, features: Sequence[str], repeats: int = PM.REPEATS) -> DataFrame:
    """Drop in average precision on the current side when a column is permuted, for the class-weighted logistic model fitted on
    the reference side (medians fitted there too, a flag for each missing value)."""
    stats = FE.development_stats(wide, features, fit=F.col("side") == "reference")
    train = _with_weights(_prepared(wide.where(F.col("side") == "reference"), features, stats))
    model = estimator("logistic", features, "weight").fit(train).stages[-1]
    coef, n = model.coefficients.toArray().tolist(), len(features)
    return PM.permutation_importance(wide.where(F.col("side") == "current"), features, dict(zip(features, coef[:n])),
                                     dict(zip(features, coef[n:])), float(model.intercept), FE._stat_map(stats, "median"), repeats)


def calibrate(oof: DataFrame, method: str, k: int = FOLDS, key: str = "record_id") -> DataFrame:
    """Cross-fitted calibration of OOF scores: sigmoid (logistic on p), beta (logistic on ln p, ln(1-p)),
    isotonic, or identity; fold by hash of the key; clipped to [0, 1]."""
    eps = 1e-6
    p = F.least(F.greatest(F.col("probability"), F.lit(eps)), F.lit(1 - eps))
    d = oof.select(key, "target", F.col("probability").alias("raw_probability"), (F.abs(F.xxhash64(key, F.lit(142))) % k).alias("_cf"),
                   p.alias("_p"), F.log(p).alias("_lp"), F.log(1 - p).alias("_lq"), F.col("target").cast("double").alias("label"))
    if method == "uncalibrated":
        return d.select(key, "target", F.col("raw_probability").alias("calibrated_probability"), F.lit(method).alias("method"))
    if method == "isotonic":
        data = d.select(key, "target", "label", F.col("_p").alias("score"), F.col("_cf").cast("int").alias("fold"))
        out = IS.cross_fitted(data, k).select(key, "target", F.col("fitted").alias("cp"))
    for i in range(k if method != "isotonic" else 0):
        tr, te = d.where(F.col("_cf") != i), d.where(F.col("_cf") == i)
        cols = ["_p"] if method == "sigmoid" else ["_lp", "_lq"]
        va = VectorAssembler(inputCols=cols, outputCol="features")
        m = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.0, maxIter=100).fit(va.transform(tr))
        s = m.transform(va.transform(te)).select(key, "target", vector_to_array("probability")[1].alias("cp"))
        out = s if i == 0 else out.unionByName(s)
    return out.select(key, "target", r6(F.least(F.greatest(F.col("cp"), F.lit(0.0)), F.lit(1.0))).alias(
        "calibrated_probability"), F.lit(method).alias("method"))


def path_lengths(x, trees):
    """Sum over the trees of a row's path length.  Trees are filled up to one depth: for each level the features and
    splits of its nodes, then the values of the lowest level; a node has its children at twice its place and one beyond."""
    import numpy as np

    n = len(x)
    flat, rows = np.ascontiguousarray(x.T).ravel(), np.arange(n)
    total, at, cell = np.zeros(n), np.empty(n, np.intp), np.empty(n, np.intp)
    value, split, right = np.empty(n), np.empty(n), np.empty(n, bool)
    for feats, splits, leaves in trees:
        at.fill(0)
        for f, s in zip(feats, splits):
            (f * n).take(at, out=cell, mode="clip")
            np.add(cell, rows, out=cell)
            flat.take(cell, out=value, mode="clip")
            s.take(at, out=split, mode="clip")
            np.greater_equal(value, split, out=right)
            np.add(at, at, out=at)
            np.add(at, right, out=at)
        total += leaves.take(at, mode="clip")
    return total


def isolation_scores(wide: DataFrame, features: Sequence[str], trees: int = 500, sample: int = 256,
                     key: str = "o_orderkey") -> DataFrame:
    """Isolation forest: each tree is grown (in ``applyInPandas`` by tree id) on the ``sample`` pass rows
    of the reference side with the tree's smallest hashes, ties by key; the trees (small, bounded by trees x sample) are broadcast
    and every row's mean path length is computed in ``mapInPandas``; score = 2^(-E[h]/c(n)).

    Records without an id are left out; records that share one are scored once with each of its keys."""
    import numpy as np
    import pandas as pd

    wide = _stored(wide, features, key)
    prep = _prepared(wide, features, FE.medians(wide, features, F.col("side") == "reference"), [key]).where("record_id is not null")
    if not prep.groupBy("record_id").count().where("count > 1").isEmpty():
        prep = prep.drop(key).join(wide.select("record_id", key), "record_id")
    ref = prep.where((F.col("side") == "reference") & (F.col("target") == 0))
    n_ref = ref.count()
    frac = min(1.0, 2.0 * sample / max(n_ref, 1))
    reps = wide.sparkSession.range(trees).select(F.col("id").cast("int").alias("tree"))
    samp = ref.crossJoin(F.broadcast(reps)).withColumn("_u", unit_hash(F.col(key), F.col("tree"), salt=SEED)).where(F.col("_u") < frac)
    w = Window.partitionBy("tree").orderBy("_u", key)  # about 2 * sample rows of each tree
    samp = samp.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= sample)
    cols = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(SEED + t)
        x = pdf[cols].to_numpy(dtype=float)
        nodes = []  # (node id, feature idx, split, left, right, size)

        def build(idx, depth, limit):
            nid = len(nodes)
            nodes.append([nid, -1, 0.0, -1, -1, len(idx)])
            if depth >= limit or len(idx) <= 1:
                return nid
            f = int(rng.integers(len(cols)))
            lo, hi = x[idx, f].min(), x[idx, f].max()
            if hi <= lo:
                return nid
            s = float(rng.uniform(lo, hi))
            nodes[nid][1], nodes[nid][2] = f, s
            nodes[nid][3] = build(idx[x[idx, f] < s], depth + 1, limit)
            nodes[nid][4] = build(idx[x[idx, f] >= s], depth + 1, limit)
            return nid

        build(np.arange(len(x)), 0, int(np.ceil(np.log2(max(len(x), 2)))))
        return pd.DataFrame([[t] + n for n in nodes], columns=["tree", "node", "feat", "split", "left", "right", "size"])

    forest = samp.select("tree", *cols).groupBy("tree").applyInPandas(
        grow, "tree int, node long, feat long, split double, left long, right long, size long")
    model = forest.toPandas()  # trees x nodes: bounded by trees * 2 * sample, never by the data
    psize = min(sample, max(n_ref, 2))

    def c(n):
        return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else (1.0 if n == 2 else 0.0)

    by_tree = {t: g.set_index("node") for t, g in model.groupby("tree")}
    cn = c(psize)

    depth = 0
    grown = []
    for g in by_tree.values():
        feat, split, left, right, size = (g[k].to_numpy() for k in ("feat", "split", "left", "right", "size"))
        place = {0: (0, 0)}  # node: level, place in the level
        for node in np.flatnonzero(feat >= 0).tolist():  # parents come before their children
            d, k = place[node]
            place[int(left[node])], place[int(right[node])] = (d + 1, 2 * k), (d + 1, 2 * k + 1)
        depth = max([depth, *[d for d, _ in place.values()]])
        grown.append((feat, split, size, place))
    trees_np = []
    for feat, split, size, place in grown:
        feats, splits = [np.zeros(1 << d, np.intp) for d in range(depth)], [np.full(1 << d, np.inf) for d in range(depth)]
        leaves = np.zeros(1 << depth)
        for node, (d, k) in place.items():
            if feat[node] >= 0:
                feats[d][k], splits[d][k] = feat[node], split[node]
            else:  # a leaf above the lowest level has its value on all places below
                leaves[k << depth - d:(k + 1) << depth - d] = d + c(int(size[node]))
        trees_np.append((feats, splits, leaves))

    def score(batches):
        for pdf in batches:
            total = path_lengths(pdf[cols].to_numpy(dtype=float), trees_np)
            eh = total / max(len(trees_np), 1)
            yield pd.DataFrame({"record_id": pdf["record_id"], "anomaly_score": 2.0 ** (-eh / cn)})

    return prep.select("record_id", *cols).mapInPandas(score, "record_id string, anomaly_score double").select(
        "record_id", r6(F.col("anomaly_score")).alias("anomaly_score"))


def imputation_ranking(wide: DataFrame, features: Sequence[str], rounds: int = IM.ROUNDS, trees: int = IM.TREES) -> DataFrame:
    """Median against chained imputation: the same class-weighted logistic model on either, fitted on the reference side, compared on
    the current side and ranked by cost, false alarms, precision, balanced accuracy and PR-AUC."""
    wide = _stored(wide, features)
    ref = F.col("side") == "reference"
    chained = IM.chained_impute(wide, features, ref, rounds, trees)
    rest = wide.select("record_id", "target", "side")
    scores = fit_score(wide, features, "logistic").withColumn("model", F.lit("median_imputation")).unionByName(
        fit_score(rest.join(chained, "record_id"), features, "logistic").withColumn("model", F.lit("chained_imputation")))
    return M.select_model(M.model_comparison(cut_lineage(scores)))
