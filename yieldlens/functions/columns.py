"""Column discovery and the wide <-> long forms.

Discovery only reads ``df.schema`` (driver metadata); no rows move.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FEATURE_PREFIXES, ROLE_ALIASES

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def normalise_name(name: str) -> str:
    """lower-case, non-alphanumerics folded to single underscores, trimmed."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def ordered_unique(items: Iterable[str]) -> list[str]:
    seen: set[str] = set()
    out = []
    for x in items:
        if x not in seen:
            seen.add(x)
            out.append(x)
    return out


def discover_roles(df: DataFrame, aliases: dict[str, list[str]] | None = None) -> dict[str, str | None]:
    """First alias hit per role on normalised column names."""
    aliases = aliases or ROLE_ALIASES
    by_norm: dict[str, str] = {}
    for c in df.columns:
        by_norm.setdefault(normalise_name(c), c)
    roles: dict[str, str | None] = {}
    for role, cands in aliases.items():
        roles[role] = next((by_norm[normalise_name(a)] for a in cands if normalise_name(a) in by_norm), None)
    return roles


def select_sensor_columns(
    df: DataFrame,
    prefixes: Sequence[str] = tuple(FEATURE_PREFIXES),
    exclude: Sequence[str] = (),
    maximum_features: int | None = None,
    role_columns: Sequence[str] = (),
) -> list[str]:
    """Columns by prefix; if none match, every numeric column minus roles and excludes; order kept."""
    excl = set(exclude) | set(role_columns)
    cols = [c for c in df.columns if any(c.startswith(p) for p in prefixes) and c not in excl]
    if not cols:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in excl]
    cols = ordered_unique(cols)
    return cols[:maximum_features] if maximum_features else cols


def finite(col: str | F.Column) -> F.Column:
    """NaN and +-inf become NULL so that aggregates skip them."""
    c = F.col(col) if isinstance(col, str) else col
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)


def to_long(df: DataFrame, ids: Sequence[str], features: Sequence[str], *, feature: str = "feature",
            value: str = "value") -> DataFrame:
    """Wide -> long (ids..., feature, value); NULL values are kept (missingness is data)."""
    prepared = df.select(*ids, *[finite(c).alias(c) for c in features])
    return prepared.unpivot(list(ids), list(features), feature, value)


def row_array(features: Sequence[str]) -> F.Column:
    return F.array(*[finite(c) for c in features])
