"""Several tables published together: all of them are seen at once or none.

Tables are written by Spark to a staging folder of their own, read back from there, counted and digested, and only then
named by one manifest, whose appearance under its final name is a single rename that fails if the name is taken.  Readers
take the manifest with the highest version and nothing else, so a write that fails half-way leaves the last published
version in place, and of two writers of one version the later takes the next one.

The digest of a table is the sum of 32-bit numbers from the MD5 of each row's canonical text: it depends on the rows and
how often each occurs, not on their order or files, and adds up in parallel.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = "manifest-"
NULL = "\\N"
LISTING = "version long, table_name string, row_count long, digest decimal(38,0), path string"


def canonical_row(df: DataFrame) -> Column:
    """The row as text, columns by name: times as microseconds, fractions in whole millionths, null apart from any text."""
    def said(name: str) -> Column:
        kind = df.schema[name].dataType
        c = F.col(f"`{name}`")
        if isinstance(kind, T.TimestampNTZType):  # no zone: counted from the same clock's 1970, whatever the session's zone
            c = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
        elif isinstance(kind, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c * 1_000_000).cast("long")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        return F.coalesce(c.cast("string"), F.lit(NULL))

    return F.concat_ws("|", *[said(c) for c in sorted(df.columns)])


def digest(df: DataFrame) -> DataFrame:
    """One row: row_count and digest of a table (empty: 0 and 0)."""
    number = F.conv(F.substring(F.md5(canonical_row(df).cast("binary")), 1, 8), 16, 10).cast("decimal(38,0)")
    return df.select(number.alias("_n")).agg(F.count(F.lit(1)).alias("row_count"),
                                             F.coalesce(F.sum("_n"), F.lit(0)).cast("decimal(38,0)").alias("digest"))


def _hadoop(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = jvm.Path(folder)
    return jvm, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Published versions, oldest first."""
    _, path, fs = _hadoop(spark, folder)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[len(PREFIX) : -len(".json")]) for n in names if n.startswith(PREFIX) and n.endswith(".json"))


def _put(spark: SparkSession, folder: str, version: int, text: str) -> bool:
    """The manifest under its final name by one rename; False where that version exists."""
    jvm, path, fs = _hadoop(spark, folder)
    staged, final = jvm.Path(path, f"_{uuid.uuid4().hex}.json"), jvm.Path(path, f"{PREFIX}{version:012d}.json")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm, "Options$Rename")
    context = jvm.FileContext.getFileContext(path.toUri() if path.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(staged), fs.makeQualified(final), spark.sparkContext._gateway.new_array(rename, 0))
    except Exception as taken:
        if "AlreadyExists" not in str(taken):
            raise
        fs.delete(staged, False)
        return False
    return True


def publish(tables: Mapping[str, DataFrame], folder: str) -> int:
    """Write all tables and publish them as one version, which is returned.  On any failure nothing is published."""
    if not tables:
        raise ValueError("a bundle needs at least one table")
    spark = next(iter(tables.values())).sparkSession
    stage = f"{folder.rstrip('/')}/tables-{uuid.uuid4().hex}"
    listed = []
    for name, df in tables.items():
        path = f"{stage}/{name}"
        df.write.parquet(path)
        row = digest(spark.read.schema(df.schema).parquet(path)).first()  # of what is in the files
        listed.append({"table_name": name, "row_count": row["row_count"], "digest": str(row["digest"]), "path": path,
                       "schema": df.schema.jsonValue()})
    version = max(versions(spark, folder), default=0) + 1
    while not _put(spark, folder, version, json.dumps({"tables": listed})):
        version += 1
    return version


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> list[dict]:
    """The tables of a published version (default: the latest)."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no published bundle in {folder}" if not known else f"no version {version} in {folder}")
    version = known[-1] if version is None else version
    text = spark.read.text(f"{folder.rstrip('/')}/{PREFIX}{version:012d}.json", wholetext=True).first()[0]
    return [{"version": version, **t} for t in json.loads(text)["tables"]]


def listing(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """version, table_name, row_count, digest, path of a published version."""
    from decimal import Decimal

    rows = [(t["version"], t["table_name"], t["row_count"], Decimal(t["digest"]), t["path"]) for t in manifest(spark, folder, version)]
    return spark.createDataFrame(rows, LISTING)


def read(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    """One table of a published version."""
    for t in manifest(spark, folder, version):
        if t["table_name"] == name:
            return spark.read.schema(T.StructType.fromJson(t["schema"])).parquet(t["path"])
    raise KeyError(name)


def verified(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """version, table_name and whether the files still hold the rows that the manifest lists."""
    rows = []
    for t in manifest(spark, folder, version):
        now = digest(read(spark, folder, t["table_name"], t["version"])).first()
        rows.append((t["version"], t["table_name"], now["row_count"] == t["row_count"] and str(now["digest"]) == t["digest"]))
    return spark.createDataFrame(rows, "version long, table_name string, intact boolean")
