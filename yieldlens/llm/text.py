"""Shared text pieces: word patterns, table access and numpy kernels over Arrow string columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A word of the size, quality and shingle operators: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: One white-space character of that definition.
SPACE = r"[\x20\x09-\x0D]"

#: Rows of a few numbers that may be broadcast.
BROADCAST_ROWS = 200_000

#: Odd base of the polynomial hash modulo 2**64 and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark's own reader (any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matching(docs: DataFrame, rows: DataFrame, keys: dict[str, Column], how: str) -> DataFrame:
    """Rows of ``docs`` that have (left_semi) or have not (left_anti) a partner in ``rows``, null keys being equal.

    ``keys`` gives the value of each column of ``rows`` as an expression over ``docs``; columns of ``docs`` may have any
    names.  ``rows`` is stored and counted first: up to BROADCAST_ROWS of them are broadcast, so that the texts stay where they
    are; more are joined by shuffle."""
    rows = cut_lineage(rows)
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),
                       *[value.alias(f"_key{i}") for i, value in enumerate(keys.values())])
    other = rows.select(*[F.col(c).alias(f"_match{i}") for i, c in enumerate(keys)])
    other = F.broadcast(other) if rows.count() <= BROADCAST_ROWS else other
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"_key{i}").eqNullSafe(F.col(f"_match{i}"))
    return held.join(other, same, how).select(*[F.col("_doc")[c].alias(c) for c in docs.columns])


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int):
    """Row ranges [a, b) of at most ``limit`` bytes each (one row at least), so that work arrays stay small."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply, xor and shift), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each range: equal contents give equal numbers."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(INVERSE, n + 1)[starts])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z on UTF-8 bytes; nothing else changes."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words of the rows, and n + 1 offsets of the rows' words; rows part words."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before[edges], after[edges - 1] = False, False
    starts, ends = np.nonzero(inside & ~before)[0], np.nonzero(inside & ~after)[0] + 1
    return starts, ends, np.searchsorted(starts, offsets)
