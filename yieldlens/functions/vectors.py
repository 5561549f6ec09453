"""Vectorised helpers for pandas UDFs (kept free of postponed annotations: the UDF type hints must be real)."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_udf(function):
    """A pandas UDF of one string column that maps every non-null value."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(function, na_action="ignore")

    return F.pandas_udf(run, T.StringType())
