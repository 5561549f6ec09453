"""Registered similarity queries over ``embeddings`` (exact kNN by pivot pruning); DuckDB brute-force twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import r6
from ..operators import similarity as SM
from ..sources import fixtures as fx


def _emb(spark, sf):
    return SM.split_reference(fx.table(spark, sf, "embeddings"))


def q_nearest_cases(spark, sf):
    c = SM.nearest_cases(fx.table(spark, sf, "embeddings"))
    return c.select("query_id", "rank", "neighbour_id", "neighbour_target", r6(F.col("distance")).alias("distance"),
                    r6(F.col("similarity")).alias("similarity"), r6(F.col("distance_scale")).alias("distance_scale"))


def q_distance_scale(spark, sf):
    e = _emb(spark, sf)
    return SM.distance_scale(e.where("is_reference")).select(r6(F.col("distance_scale")).alias("distance_scale"))


def q_knn_distance(spark, sf):
    e = _emb(spark, sf)
    nn = SM.knn(e.where("is_reference"), e, 5, exclude_self=True)
    return nn.groupBy(F.col("query_id")).agg(r6(F.avg("distance")).alias("mean_neighbour_distance"),
                                             F.count(F.lit(1)).alias("neighbours"))


def _summary(spark, sf):
    emb = _emb(spark, sf)
    cases = SM.nearest_cases(fx.table(spark, sf, "embeddings"))
    return SM.similarity_summary(cases, emb)


def q_similarity_summary(spark, sf):
    return _summary(spark, sf)


def q_weighted_failure_rate(spark, sf):
    return _summary(spark, sf).select("query_id", "weighted_failure_rate")


def q_wilson_interval(spark, sf):
    return _summary(spark, sf).select("query_id", "failed_neighbours", "neighbours", "wilson_lower", "wilson_upper")


def q_similarity_labels(spark, sf):
    return _summary(spark, sf).select("query_id", "similarity_strength", "historical_evidence")


def q_similarity_groups(spark, sf):
    return SM.similarity_groups(_summary(spark, sf))


def q_check_unique_ids(spark, sf):
    return SM.check_unique_ids(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_pca_embedding(spark, sf):
    return SM.pca_embedding(fx.table(spark, sf, "embeddings")).select("vec_id", "n_components")


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

_DIST = ("sqrt(list_reduce(list_transform(list_zip({a}, {b}), lambda t: (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE))"
         " * (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE))), lambda x, y: x + y, 0.0))")
_BASE = [
    """e AS (SELECT vec_id, embedding, label, vec_id < floor(count(*) OVER () * 0.8) AS is_reference,
      CASE WHEN label = 0 THEN 1 ELSE 0 END AS target FROM embeddings)""",
    "ref AS (SELECT * FROM e WHERE is_reference)",
    "cur AS (SELECT * FROM e WHERE NOT is_reference)",
    f"""selfnn AS (SELECT * FROM (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, {_DIST.format(a='q.embedding', b='r.embedding')} AS distance
        FROM ref q JOIN ref r ON q.vec_id <> r.vec_id) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) <= 10)""",
    "scale AS (SELECT coalesce(quantile_cont(distance, 0.5) FILTER (WHERE distance > 0), 1.0) AS distance_scale FROM selfnn)",
    f"""nn AS (SELECT * FROM (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, r.target AS neighbour_target,
        {_DIST.format(a='q.embedding', b='r.embedding')} AS distance,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY {_DIST.format(a='q.embedding', b='r.embedding')}, r.vec_id) AS rank
        FROM cur q, ref r) WHERE rank <= 10)""",
    """cases AS (SELECT query_id, rank, neighbour_id, neighbour_target, distance,
        exp(-distance / distance_scale) AS similarity, distance_scale FROM nn, scale)""",
    """sm AS (SELECT query_id, count(*) AS neighbours, count(*) FILTER (WHERE neighbour_target = 1) AS failed,
        avg(similarity) AS ms, avg(similarity) FILTER (WHERE neighbour_target = 1) AS mfs,
        avg(similarity) FILTER (WHERE neighbour_target = 0) AS mps, sum(neighbour_target * similarity) AS ts,
        sum(similarity) AS ss, avg(neighbour_target) AS mt, avg(distance) AS md FROM cases GROUP BY query_id)""",
    """sm2 AS (SELECT sm.*, CASE WHEN ss > 1e-12 THEN ts / ss ELSE mt END AS rate, failed / neighbours AS p,
        1 + 1.96 * 1.96 / neighbours AS den FROM sm)""",
    """sm3 AS (SELECT *, (p + 1.96 * 1.96 / (2 * neighbours)) / den AS centre,
        1.96 * sqrt(p * (1 - p) / neighbours + 1.96 * 1.96 / (4 * neighbours * neighbours)) / den AS half,
        CASE WHEN ms >= 0.75 THEN 'Very Strong' WHEN ms >= 0.55 THEN 'Strong' WHEN ms >= 0.35 THEN 'Moderate'
             WHEN ms >= 0.2 THEN 'Weak' ELSE 'Very Weak' END AS lab FROM sm2)""",
    """ss_t AS (SELECT s.query_id, e.target AS query_target, neighbours, failed AS failed_neighbours,
        neighbours - failed AS passed_neighbours, round(ms, 6) AS mean_similarity, round(mfs, 6) AS mean_failed_similarity,
        round(mps, 6) AS mean_passed_similarity, round(md, 6) AS mean_distance, round(rate, 6) AS weighted_failure_rate,
        round(greatest(centre - half, 0.0), 6) AS wilson_lower, round(least(centre + half, 1.0), 6) AS wilson_upper,
        lab AS similarity_strength,
        CASE WHEN failed >= 3 AND rate >= 0.3 AND lab IN ('Very Strong', 'Strong') THEN 'Strong Failure Evidence'
             WHEN failed >= 2 AND rate >= 0.2 THEN 'Moderate Failure Evidence'
             WHEN failed >= 1 THEN 'Limited Failure Evidence' ELSE 'No Failure Evidence' END AS historical_evidence
      FROM sm3 s LEFT JOIN e ON e.vec_id = s.query_id)""",
]
W = "WITH " + ",\n".join(_BASE) + "\n"

SQL = {
    "nearest_cases": W + """SELECT query_id, rank, neighbour_id, neighbour_target, round(distance, 6) AS distance,
        round(similarity, 6) AS similarity, round(distance_scale, 6) AS distance_scale FROM cases""",
    "distance_scale": W + "SELECT round(distance_scale, 6) AS distance_scale FROM scale",
    "knn_distance": "WITH " + ",\n".join(_BASE[:2]) + f""",
      k5 AS (SELECT * FROM (SELECT q.vec_id AS query_id, {_DIST.format(a='q.embedding', b='r.embedding')} AS distance,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY {_DIST.format(a='q.embedding', b='r.embedding')}, r.vec_id) AS rk
        FROM e q JOIN ref r ON q.vec_id <> r.vec_id) WHERE rk <= 5)
      SELECT query_id, round(avg(distance), 6) AS mean_neighbour_distance, count(*) AS neighbours FROM k5 GROUP BY query_id""",
    "similarity_summary": W + "SELECT * FROM ss_t",
    "weighted_failure_rate": W + "SELECT query_id, weighted_failure_rate FROM ss_t",
    "wilson_interval": W + "SELECT query_id, failed_neighbours, neighbours, wilson_lower, wilson_upper FROM ss_t",
    "similarity_labels": W + "SELECT query_id, similarity_strength, historical_evidence FROM ss_t",
    "similarity_groups": W + """SELECT CASE WHEN query_target = 1 THEN 'Failure' ELSE 'Pass' END AS outcome, count(*) AS queries,
        round(avg(mean_similarity), 6) AS mean_similarity, round(avg(weighted_failure_rate), 6) AS mean_weighted_failure_rate,
        round(avg(failed_neighbours), 6) AS mean_failed_neighbours, """
    + ", ".join(f"round(avg(CASE WHEN failed_neighbours >= {m} THEN 1 ELSE 0 END), 6) AS retrieval_at_{m}"
                for m in SM.RETRIEVAL_LEVELS) + " FROM ss_t GROUP BY 1",
    "check_unique_ids": """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
}
