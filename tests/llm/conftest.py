import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from yieldlens.session import local_session

    yield local_session("*", shuffle_partitions=4)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text[, source]) rows, with extra columns under clashing names."""
    from pyspark.sql import functions as F

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in ("size", "tie", "h", "n", "target", "host", "_taken", "_r", "shard"):
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make
