"""Bronze -> Silver: rename, null-key filter, dedupe, timestamp derivation.

Each builder is ``DataFrame -> DataFrame``; reading and writing stay with the
caller (``basketry.sources``). Column names are the source's, lower-cased.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.functions.timestamps import parse_iso_utc, time_of_day
from basketry.operators.columns import move_to_end, normalize_columns
from basketry.operators.dedupe import dedupe_on_key

DATE_KEY = ["date_key"]
ORDER_LINE_KEY = ["lineitem_id"]
OPTION_KEY = ["lineitem_id", "option_group_name", "option_name"]
DERIVED_TIME_COLUMNS = ["creation_ts_utc", "creation_date", "creation_time"]


def dim_date(
    bronze: DataFrame,
    order_by: Sequence[str] | str | None = None,
    expected: StructType | None = None,
) -> DataFrame:
    """Silver ``dim_date``: lower-case names, one row per ``date_key``."""
    df = normalize_columns(bronze, expected)
    return dedupe_on_key(df, DATE_KEY, order_by)


def fact_orders(
    bronze: DataFrame,
    order_by: Sequence[str] | str | None = None,
    expected: StructType | None = None,
    time_column: str = "creation_time_utc",
) -> DataFrame:
    """Silver ``fact_orders`` (one row per line item).

    Drops NULL ``lineitem_id``, keeps one row per line item, parses the UTC
    time string into ``creation_ts_utc`` / ``creation_date`` /
    ``creation_time`` (unparsable -> NULL), drops the raw string and puts the
    three derived columns last. The filter sits right after the scan, so it
    is pushed into the Parquet reader.
    """
    df = normalize_columns(bronze, expected)
    df = df.where(F.col("lineitem_id").isNotNull())
    df = dedupe_on_key(df, ORDER_LINE_KEY, order_by)
    ts = parse_iso_utc(time_column)
    df = df.select(
        *[c for c in df.columns if c != time_column and c not in DERIVED_TIME_COLUMNS],
        ts.alias("creation_ts_utc"),
    )
    df = df.withColumns(
        {
            "creation_date": F.to_date("creation_ts_utc"),
            "creation_time": time_of_day("creation_ts_utc"),
        }
    )
    return move_to_end(df, DERIVED_TIME_COLUMNS)


def fact_options(
    bronze: DataFrame,
    order_by: Sequence[str] | str | None = None,
    expected: StructType | None = None,
) -> DataFrame:
    """Silver ``fact_options``: one row per (line, option group, option).

    NULL keys are kept (no null-key filter here, unlike order lines).
    """
    df = normalize_columns(bronze, expected)
    return dedupe_on_key(df, OPTION_KEY, order_by)
