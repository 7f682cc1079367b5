"""Column-name and projection helpers (metadata only, no data movement)."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def duplicate_column_names(df: DataFrame, case_insensitive: bool = False) -> list[str]:
    """Column names that occur more than once (2nd and later occurrences)."""
    names = [c.lower() if case_insensitive else c for c in df.columns]
    seen: set[str] = set()
    dups = []
    for n in names:
        if n in seen:
            dups.append(n)
        seen.add(n)
    return dups


def normalize_columns(df: DataFrame, expected: StructType | None = None) -> DataFrame:
    """Lower-case every column name in one projection.

    Raises if two names collide after lower-casing (Spark itself would accept
    the ambiguous frame). With ``expected`` the result is also cast to that
    schema and checked for missing columns (schema enforcement, off by
    default).
    """
    lowered = [c.lower() for c in df.columns]
    clashes = [n for n, k in Counter(lowered).items() if k > 1]
    if clashes:
        raise ValueError(f"column names collide after lower-casing: {sorted(clashes)}")
    out = df.toDF(*lowered)
    if expected is not None:
        missing = [f.name for f in expected.fields if f.name not in lowered]
        if missing:
            raise ValueError(f"missing columns for schema enforcement: {missing}")
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in expected.fields])
    return out


def move_to_end(df: DataFrame, last: list[str]) -> DataFrame:
    """Keep column order but put ``last`` at the end, in the given order."""
    first = [c for c in df.columns if c not in last]
    return df.select(*first, *last)


def is_numeric_type(data_type) -> bool:
    from pyspark.sql.types import NumericType

    return isinstance(data_type, NumericType)


def split_numeric_text(df: DataFrame) -> tuple[list[str], list[str]]:
    """Column names split by type: numeric vs everything else."""
    numeric = [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]
    text = [f.name for f in df.schema.fields if not is_numeric_type(f.dataType)]
    return numeric, text
