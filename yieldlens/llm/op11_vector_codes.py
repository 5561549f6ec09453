"""Vector code compression: product codes with integer codebooks, distances from exact matrix products.

Components become whole numbers floor(scale * x), vectors are cut into equal consecutive parts, and every part is coded by
the nearest of a few codebook entries.  The codebooks start from the vectors with the smallest ids and are moved to
the floors of their members' means in a fixed number of rounds.

Distances come from one matrix product a part.  Whole numbers are broken into limbs of ``limb_bits`` bits, so few that
a float64 product of two limb matrices stays below 2**53 in every partial sum and is therefore exact in any order of
summation.  The limb products are shifted and added in int64, where wrapping is harmless because the distance itself
fits.  ``argmin`` returns the first of equal minima, so ties go to the lower index.  Where a distance could pass 2**63, the
batch is computed with Python's unbounded integers instead.

Scale: the whole numbers are written once; each round reads them, adds up parts, entries x components sums in every task
(a table of tasks x parts x entries rows, combined by Spark), and only the new entries reach the driver: parts x
entries x width numbers, whatever the input.  A lost executor costs its tasks only.

Cases.  Null vectors, and vectors that hold null, NaN or infinite components, are dropped.  Components beyond +-2**60 after
scaling count as +-2**60, and an error beyond 2**63 - 1 as that.  Vectors that are not of the table's most frequent
length (ties: the longest) are no vectors of this space: they get a null code and error and take no part otherwise.
A length that the parts don't divide is filled up with zeros at the end.  A null id sorts last, rows of one id by their numbers;
repeated rows are coded alike and all count.  With fewer rows than entries the codebooks are as short as the
table.  An empty table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .text import BROADCAST_ROWS, table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 60       # components are held within +-LARGEST
LONGEST = (1 << 63) - 1
CHUNK = 1 << 13         # vectors of one matrix product


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][index]`` is a tuple of whole numbers; ``length`` the vectors' length before filling up."""

    entries: tuple
    length: int
    scale: int

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        said = ",".join(str(v) for part in self.entries for entry in part for v in entry)
        return hashlib.sha256(said.encode()).hexdigest()


def limb_bits(width: int) -> int:
    """Bits of a limb whose products, ``width`` of them added up, stay below 2**53."""
    return (53 - max(width - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 matrices l_0, l_1, ... with x = sum of l_k * 2**(bits * k); all but the last are not negative."""
    out = []
    while len(x) and (x.max() >= 1 << (bits - 1) or x.min() < -(1 << (bits - 1))):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T for int64 matrices, exact modulo 2**64, from float64 products of limbs."""
    bits = limb_bits(x.shape[1])
    total = np.zeros((len(x), len(c)), np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            if bits * (i + j) < 64:
                total += (a @ b.T).astype(np.int64) << np.int64(bits * (i + j))
    return total


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of the rows of x to those of c: int64, or Python integers where int64 is too short."""
    top = max(int(max(v.max(initial=0), -v.min(initial=0))) for v in (x, c))
    if x.shape[1] * (2 * top) ** 2 <= LONGEST:
        return (x * x).sum(1)[:, None] - 2 * products(x, c) + (c * c).sum(1)[None, :]
    a, b = x.astype(object), c.astype(object)
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(2)


def nearest(x: np.ndarray, entries: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, and the squared distance to it, for a block of vectors (rows, parts, width)."""
    code = np.zeros(x.shape[:2], np.int64)
    error = []
    for p, entry in enumerate(entries):
        d = distances(x[:, p], np.array(entry, np.int64))
        code[:, p] = d.argmin(1)
        error.append(d[np.arange(len(d)), code[:, p]])
    return code, np.stack(error, axis=1)


def _blocks(column, length: int, parts: int):
    """(first row, int64 block of shape rows, parts, width) of an Arrow list column whose rows all have ``length`` numbers."""
    width = max(1, -(-length // parts))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = flat.reshape(len(column), length)
    for a in range(0, len(column), CHUNK):
        x = np.zeros((min(CHUNK, len(column) - a), parts * width), np.int64)
        x[:, :length] = flat[a : a + CHUNK]
        yield a, x.reshape(len(x), parts, width)


def _sums(books: Codebooks):
    """Task function: for each part and entry with members, their number and the sums of their components."""

    def run(batches):
        import pyarrow as pa

        parts = len(books.entries)
        count: dict = {}
        total: dict = {}
        for batch in batches:
            for _, x in _blocks(batch.column(0), books.length, parts):
                code, _ = nearest(x, books.entries)
                wide = len(x) * LARGEST > LONGEST and np.abs(x).max(initial=0) * len(x) > LONGEST / 2
                for p in range(parts):
                    for k in np.unique(code[:, p]).tolist():
                        rows = x[code[:, p] == k, p]
                        own = rows.astype(object).sum(0) if wide else rows.sum(0)
                        count[p, k] = count.get((p, k), 0) + len(rows)
                        total[p, k] = [a + int(b) for a, b in zip(total.get((p, k), [0] * len(own)), own)]
        rows = [(p, k, i, count[p, k], v) for (p, k), sums in sorted(total.items()) for i, v in enumerate(sums)]
        cols = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.decimal128(38, 0))],
            names=["part", "entry", "at", "members", "total"])

    return run


def whole_numbers(vectors: DataFrame, vec: str, scale: int = SCALE) -> DataFrame:
    """The rows whose vector is usable, with the components as whole numbers in ``_q``."""
    usable = F.col(vec).isNotNull() & ~F.exists(
        F.col(vec), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = lambda x: F.least(F.greatest(F.floor(x.cast("double") * F.lit(float(scale))), F.lit(-LARGEST)), F.lit(LARGEST))
    return vectors.where(F.coalesce(usable, F.lit(False))).withColumn("_q", F.transform(F.col(vec), scaled))


def fit(numbers: DataFrame, id_col: str = "_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: int = SCALE) -> Codebooks | None:
    """Codebooks of a stored table of whole numbers ``_q`` (see whole_numbers); None where it is empty."""
    sizes = numbers.groupBy(F.size("_q").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if sizes is None:
        return None
    length = sizes["length"]
    width = max(1, -(-length // parts))
    of_space = numbers.where(F.size("_q") == length)
    seeds = of_space.orderBy(F.col(id_col).asc_nulls_last(), "_q").limit(entries).select("_q").collect()
    filled = [[*r["_q"], *[0] * (parts * width - length)] for r in seeds]
    books = Codebooks(tuple(tuple(tuple(v[p * width : (p + 1) * width]) for v in filled) for p in range(parts)), length, scale)
    for _ in range(rounds):
        sums = of_space.select("_q").mapInArrow(_sums(books), "part int, entry int, at int, members long, total decimal(38,0)")
        moved = [[list(e) for e in part] for part in books.entries]
        for r in sums.groupBy("part", "entry", "at").agg(F.sum("members").alias("n"), F.sum("total").alias("t")).collect():
            moved[r["part"]][r["entry"]][r["at"]] = int(r["t"]) // int(r["n"])  # // goes down
        books = Codebooks(tuple(tuple(tuple(e) for e in part) for part in moved), length, scale)
    return books


def encode(numbers: DataFrame, books: Codebooks, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with ``codes`` (an index for each part) and ``error``; null for vectors of another length."""
    schema = T.StructType([numbers.schema[c] for c in keep]
                          + [T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])

    def run(batches):
        import pyarrow as pa

        parts = len(books.entries)
        for batch in batches:
            column = batch.column(len(keep))
            codes, errors = np.zeros((len(column), parts), np.int32), np.zeros(len(column), np.int64)
            fits = column.is_valid().to_numpy(zero_copy_only=False)
            for a, x in _blocks(column.drop_null(), books.length, parts):
                at = np.nonzero(fits)[0][a : a + len(x)]
                code, error = nearest(x, books.entries)
                if error.max(initial=0) > LONGEST // parts:
                    error = error.astype(object)
                codes[at] = code
                errors[at] = np.minimum(error.sum(1), LONGEST).astype(np.int64)
            ends = pa.array(np.arange(0, (len(column) + 1) * parts, parts), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()), mask=pa.array(~fits))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lists, pa.array(errors, mask=~fits)],
                                             names=[*keep, "codes", "error"])

    fitting = F.when(F.size("_q") == books.length, F.col("_q")).alias("_fit")
    return numbers.select(*keep, fitting).mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """The rows with ``vector``, the entries that ``codes`` names, scaled back to doubles (null codes: null)."""
    whole = F.array(*[F.array(*[F.array(*[F.lit(v / books.scale) for v in entry]) for entry in part]) for part in books.entries])
    parts = F.transform(F.col("codes"), lambda k, p: F.get(F.get(whole, p), k))
    return codes.withColumn("vector", F.slice(F.flatten(parts), 1, books.length))


def compressed(vectors: DataFrame, id_col: str, vec: str, group: str, **options) -> DataFrame:
    """``id_col``, codes, error, the error of all rows of equal ``group`` and the codebooks' digest for every usable vector.

    Sums of groups are broadcast up to BROADCAST_ROWS of them and joined by shuffle beyond (skewed groups are split there by
    adaptive execution)."""
    held = vectors.select(F.col(id_col).alias("_id"), F.col(group).alias("_group"), F.col(vec).alias("_vec"))
    numbers = cut_lineage(whole_numbers(held, "_vec", options.get("scale", SCALE)).select("_id", "_group", "_q"))
    books = fit(numbers, **options)
    if books is None:
        return numbers.select(F.col("_id").alias(id_col), F.lit(None).cast("array<int>").alias("codes"),
                              *[F.lit(0).cast("long").alias(c) for c in ("error", "group_error")],
                              F.lit("").alias("codebooks_sha256"))
    coded = cut_lineage(encode(numbers, books, ["_id", "_group"]))
    sums = cut_lineage(coded.groupBy(F.col("_group").alias("_of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST)).cast("long").alias("group_error")))
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums
    return coded.join(sums, F.col("_group").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias(id_col), "codes", "error", "group_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes, errors and codebook digest of all embeddings."""
    out = compressed(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    digits = F.transform("codes", lambda k: F.lower(F.lpad(F.hex(k), 2, "0")))
    return out.select("vec_id", F.when(F.col("codes").isNotNull(), F.concat_ws("", digits)).alias("code"), "error",
                      F.col("group_error").alias("label_error"), "codebooks_sha256")


def _sql() -> str:
    """The same in DuckDB: one pair of common tables a round."""
    steps = [f"""k AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS r,
        list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS q FROM embeddings
      WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))))""",
             f"""pt AS MATERIALIZED (SELECT r, p, list_slice(q, p * (len(q) // {PARTS}) + 1, (p + 1) * (len(q) // {PARTS})) AS v
        FROM k, range({PARTS}) AS t(p))""",
             f"""s AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS e FROM k
        QUALIFY e < {ENTRIES})""",
             "b0 AS MATERIALIZED (SELECT p, e, v AS c FROM pt JOIN s USING (r))"]
    near = """a{i} AS MATERIALIZED (SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM
        (SELECT r, pt.p, e, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
         FROM pt JOIN b{i} USING (p)) GROUP BY r, p)"""
    for i in range(ROUNDS):
        steps += [near.format(i=i),
                  f"""u{i} AS (SELECT p, e, i, CAST(sum(v[i]) AS BIGINT) AS t, count(*) AS n FROM a{i} JOIN pt USING (r, p),
        range(1, (SELECT max(len(v)) + 1 FROM pt)) AS g(i) GROUP BY p, e, i)""",
                  f"""m{i} AS (SELECT p, e, list((t - (t % n + n) % n) // n ORDER BY i) AS c FROM u{i} GROUP BY p, e)""",
                  f"""b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN m{i} USING (p, e))"""]
    steps += [near.format(i=ROUNDS),
              f"""w AS (SELECT r, string_agg(lpad(printf('%x', e), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM a{ROUNDS} GROUP BY r)""",
              f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})"]
    return "WITH " + ",\n".join(steps) + """
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
      FROM k JOIN w USING (r), h"""


SQL = _sql()
