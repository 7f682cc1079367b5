"""Relational source -> Bronze ingestion over JDBC.

* :func:`sqlserver_url` builds a SQL Server URL;
* :func:`jdbc_options` builds the reader options (pure, testable);
* :func:`read_table` reads a table, in parallel when a numeric/date
  partition column and bounds are given (the original read used one
  connection and therefore one task per table);
* :func:`read_query` pushes a query down to the database;
* :func:`discover_partitioning` finds the bounds for a parallel read with one
  pushed-down ``MIN``/``MAX`` query;
* :func:`balanced_ranges` finds ranges that hold about equally many rows, from
  one pushed-down quantile query, for :func:`read_ranges`;
* :func:`key_columns` finds the primary key columns of every table;
* :func:`list_tables` runs a catalog query and returns ``schema.table`` names;
* :func:`ingest_all` copies every table to ``<base>/<schema>_<table>/`` with
  per-table error isolation and returns a status DataFrame.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from basketry.sources.parquet import write_parquet

log = logging.getLogger(__name__)

# Fixed value: catalog query for SQL Server style databases (base tables of
# all schemas). Other databases pass their own, returning the same columns.
INFORMATION_SCHEMA_TABLES = (
    "(SELECT TABLE_SCHEMA, TABLE_NAME FROM INFORMATION_SCHEMA.TABLES "
    "WHERE TABLE_TYPE = 'BASE TABLE') AS tables"
)

# Fixed value: primary key columns of all tables, in key order, from the same
# standard catalog views.
INFORMATION_SCHEMA_KEYS = (
    "(SELECT k.TABLE_SCHEMA, k.TABLE_NAME, k.COLUMN_NAME, k.ORDINAL_POSITION "
    "FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS c JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE k "
    "ON k.CONSTRAINT_SCHEMA = c.CONSTRAINT_SCHEMA AND k.CONSTRAINT_NAME = c.CONSTRAINT_NAME "
    "AND k.TABLE_SCHEMA = c.TABLE_SCHEMA AND k.TABLE_NAME = c.TABLE_NAME "
    "WHERE c.CONSTRAINT_TYPE = 'PRIMARY KEY') AS table_keys"
)

STATUS_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("target_path", StringType(), True),
        StructField("rows", LongType(), True),
        StructField("status", StringType(), False),
        StructField("error", StringType(), True),
    ]
)


@dataclass(frozen=True)
class Partitioning:
    """Parallel JDBC read: ``num_partitions`` ranges of ``column`` over [lower, upper]."""

    column: str
    lower: int | str
    upper: int | str
    num_partitions: int


def jdbc_options(
    url: str,
    dbtable: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partitioning: Partitioning | None = None,
    fetch_size: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for ``spark.read.format("jdbc")``."""
    opts = {"url": url, "dbtable": dbtable}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partitioning is not None:
        if partitioning.num_partitions < 1:
            raise ValueError("num_partitions must be >= 1")
        opts.update(
            partitionColumn=partitioning.column,
            lowerBound=str(partitioning.lower),
            upperBound=str(partitioning.upper),
            numPartitions=str(partitioning.num_partitions),
        )
    if fetch_size is not None:
        opts["fetchsize"] = str(fetch_size)
    opts.update(extra or {})
    return opts


def sqlserver_url(
    host: str,
    database: str,
    port: int = 1433,
    encrypt: bool = True,
    trust_server_certificate: bool = True,
    **properties: str,
) -> str:
    """JDBC URL of a SQL Server database; further connection properties as keywords."""
    parts = {
        "databaseName": database,
        "encrypt": str(encrypt).lower(),
        "trustServerCertificate": str(trust_server_certificate).lower(),
        **properties,
    }
    return f"jdbc:sqlserver://{host}:{port};" + "".join(f"{k}={v};" for k, v in parts.items())


def read_table(spark: SparkSession, **kwargs) -> DataFrame:
    """Read one table (or derived table); see :func:`jdbc_options` for arguments."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def read_query(spark: SparkSession, url: str, query: str, alias: str = "q", **kwargs) -> DataFrame:
    """Run ``query`` inside the database and read its result."""
    return read_table(spark, url=url, dbtable=f"({query}) {alias}", **kwargs)


def discover_partitioning(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    num_partitions: int,
    **kwargs,
) -> Partitioning | None:
    """Bounds for a parallel read of ``table`` on a numeric ``column``.

    One ``MIN``/``MAX`` query runs inside the database (two numbers come
    back); ``None`` for an empty table, which is then read in one piece.
    """
    q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = read_query(spark, url, q, alias="bounds", **kwargs).first()
    if row is None or row["lo"] is None:
        return None
    return Partitioning(column, row["lo"], row["hi"], num_partitions)


def _literal(value) -> str:
    """SQL literal of a boundary value."""
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def balanced_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    columns: str | Sequence[str],
    num_partitions: int,
    condition: str | None = None,
    **kwargs,
) -> list[str]:
    """Predicates that cut ``table`` into ranges of about equally many rows.

    One query runs inside the database: ``NTILE`` over the first column, one row
    per tile back. Gaps and dense stretches of the key do not matter, as they do
    for ranges of equal width. A tile that begins and ends on one value cannot
    be cut on this column: values that fill tiles of their own become ranges
    ``column = value``, cut again by the next of ``columns`` (a composite key)
    into as many ranges as they filled tiles. The predicates exclude each other
    and cover every row; rows with a NULL key go to a range of their own.
    An empty table has two empty ranges. ``condition`` limits the rows.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    column, rest = columns[0], columns[1:]
    also = f" AND ({condition})" if condition else ""
    tiles = (
        f"SELECT tile, MIN({column}) AS lo, MAX({column}) AS hi FROM ("
        f"SELECT {column}, NTILE({num_partitions}) OVER (ORDER BY {column}) AS tile FROM {table} "
        f"WHERE {column} IS NOT NULL{also}) ranked GROUP BY tile"
    )
    # at most num_partitions rows
    rows = read_query(spark, url, tiles, alias="tiles", **kwargs).collect()
    found = [(r["lo"], r["hi"]) for r in sorted(rows, key=lambda r: r["tile"])]
    filled = Counter(lo for lo, hi in found if lo == hi)
    hot = {v: n for v, n in filled.items() if n > 1}
    # in key order: the least value of every tile, and the hot values
    cuts: list = []
    for lo, hi in found:
        for value in (lo, hi) if hi in hot else (lo,):
            if not cuts or cuts[-1] != value:
                cuts.append(value)
    prefix = f"({condition}) AND " if condition else ""
    out = [f"{prefix}{column} IS NULL"]
    if cuts and cuts[0] in hot:
        out.append(f"{prefix}{column} < {_literal(cuts[0])}")
    for i, value in enumerate(cuts):
        bounds = [f"{column} < {_literal(cuts[i + 1])}"] if i + 1 < len(cuts) else []
        if value in hot:
            same = f"{prefix}{column} = {_literal(value)}"
            out += balanced_ranges(spark, url, table, rest, hot[value], same, **kwargs) if rest else [same]
            bounds.insert(0, f"{column} > {_literal(value)}")
        elif i:
            # the first range has no lower bound: rows that arrive after the tiles are read are not lost
            bounds.insert(0, f"{column} >= {_literal(value)}")
        out.append(prefix + (" AND ".join(bounds) or f"{column} IS NOT NULL"))
    if not cuts:
        out.append(f"{prefix}{column} IS NOT NULL")
    return out


def read_ranges(spark: SparkSession, predicates: Sequence[str], **kwargs) -> DataFrame:
    """Read one table with a task per predicate; arguments as for :func:`jdbc_options`."""
    opts = jdbc_options(**kwargs)
    url, table = opts.pop("url"), opts.pop("dbtable")
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=opts)


def key_columns(
    spark: SparkSession, url: str, key_query: str = INFORMATION_SCHEMA_KEYS, **kwargs
) -> dict[str, list[str]]:
    """Primary key columns of every table that has a key, in key order (names only reach the driver).

    ``key_query`` returns schema, table, column and position, in this order of columns.
    """
    rows = read_table(spark, url=url, dbtable=key_query, **kwargs).collect()
    found: dict[str, list[str]] = {}
    for schema, table, column, _ in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        found.setdefault(f"{schema}.{table}", []).append(column)
    return found


def list_tables(
    spark: SparkSession,
    url: str,
    catalog_query: str = INFORMATION_SCHEMA_TABLES,
    schema_column: str = "TABLE_SCHEMA",
    name_column: str = "TABLE_NAME",
    **kwargs,
) -> list[str]:
    """``schema.table`` names from the catalog query (names only reach the driver)."""
    df = read_table(spark, url=url, dbtable=catalog_query, **kwargs)
    rows = df.select(schema_column, name_column).collect()
    return [f"{r[0]}.{r[1]}" for r in rows]


def target_folder(base: str, table_name: str) -> str:
    """``base`` + ``schema_table`` (dots become underscores)."""
    return f"{base.rstrip('/')}/{table_name.replace('.', '_')}"


def ingest_all(
    spark: SparkSession,
    url: str,
    target_base: str,
    tables: Sequence[str] | None = None,
    partitioning: Mapping[str, Partitioning] | None = None,
    partition_columns: Mapping[str, str] | None = None,
    num_partitions: int = 16,
    catalog_query: str = INFORMATION_SCHEMA_TABLES,
    schema_column: str = "TABLE_SCHEMA",
    name_column: str = "TABLE_NAME",
    count_rows: bool = False,
    writer: Callable[[DataFrame, str], None] | None = None,
    concurrent_tables: int = 1,
    balanced: bool = False,
    key_query: str = INFORMATION_SCHEMA_KEYS,
    **connection,
) -> DataFrame:
    """Copy each table to Parquet (full overwrite) and report per table.

    A failing table is logged and recorded with ``status="failed"`` and the
    whole error text; the others still run. A failing table enumeration
    raises. Without ``tables`` the names come from ``catalog_query``.

    ``partitioning`` gives the ranges of a parallel read per table;
    ``partition_columns`` names a numeric column per table whose bounds are
    found by one pushed-down query, read in ``num_partitions`` ranges. With
    ``balanced`` every other table is read in ranges of about equally many rows
    of its primary key (``key_query``), and named columns are cut that way too.
    A table with neither range nor key is read by one task. ``count_rows`` reads the written folder
    back to count (off by default: an extra pass). ``concurrent_tables`` > 1
    submits that many table copies at once (each is its own Spark job), so
    small tables do not leave the cluster idle.
    """
    from concurrent.futures import ThreadPoolExecutor

    if tables is not None:
        names = list(tables)
    else:
        names = list_tables(spark, url, catalog_query, schema_column, name_column, **connection)
    write = writer or (lambda df, path: write_parquet(df, path, mode="overwrite"))

    # a failing catalog of keys raises, as the one of tables does
    keys = key_columns(spark, url, key_query, **connection) if balanced else {}

    def read(name: str) -> DataFrame:
        columns = [c] if (c := (partition_columns or {}).get(name)) else keys.get(name)
        if balanced and columns and name not in (partitioning or {}):
            predicates = balanced_ranges(spark, url, name, columns, num_partitions, **connection)
            return read_ranges(spark, predicates, url=url, dbtable=name, **connection)
        return read_table(spark, url=url, dbtable=name, partitioning=ranges(name), **connection)

    def ranges(name: str) -> Partitioning | None:
        given = (partitioning or {}).get(name)
        column = (partition_columns or {}).get(name)
        if given is not None or column is None:
            return given
        return discover_partitioning(spark, url, name, column, num_partitions, **connection)

    def copy(name: str):
        path = target_folder(target_base, name)
        try:
            write(read(name), path)
            rows = spark.read.parquet(path).count() if count_rows else None
            return (name, path, rows, "ok", None)
        except Exception as exc:  # noqa: BLE001 - isolation is the contract
            log.error("failed to ingest %s", name, exc_info=True)
            return (name, path, None, "failed", f"{type(exc).__name__}: {exc}")

    if concurrent_tables > 1:
        with ThreadPoolExecutor(max_workers=concurrent_tables) as pool:
            statuses = list(pool.map(copy, names))
    else:
        statuses = [copy(n) for n in names]
    return spark.createDataFrame(statuses, STATUS_SCHEMA)
