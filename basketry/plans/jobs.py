"""Layer jobs: Bronze -> Silver and Silver -> Gold, reading and writing Parquet.

Folder names follow the lake layout of the original pipeline:
``<bronze>/dbo_date_dim``, ``dbo_order_items``, ``dbo_order_item_options``;
``<silver>/dim_date``, ``fact_orders``, ``fact_options``;
``<gold>/fact_customer``, ``fact_orders_location``.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from basketry.operators import gold, silver
from basketry.session import configure, materialize
from basketry.sources.parquet import read_parquet, write_parquet

log = logging.getLogger(__name__)

BRONZE_TABLES = {
    "dim_date": "dbo_date_dim",
    "fact_orders": "dbo_order_items",
    "fact_options": "dbo_order_item_options",
}


def _p(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


# The Gold enrichment joins order lines and options on these keys.
JOIN_KEYS = ("order_id", "lineitem_id")
BUCKETED = ("fact_orders", "fact_options")


def bronze_to_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    order_by: Sequence[str] | str | None = None,
    buckets: int | None = None,
    table_prefix: str = "silver_",
) -> dict[str, str]:
    """Build the three Silver tables; any failure stops the job.

    With ``buckets`` the two fact tables are also registered as catalog
    tables ``<table_prefix>fact_orders`` / ``fact_options``, bucketed (and
    sorted) by ``(order_id, lineitem_id)`` into the same number of buckets, so
    the Gold options aggregate and left join read co-located data and need no
    shuffle. The one extra shuffle is paid here, once per Silver build.
    """
    configure(spark)
    builders = {
        "dim_date": silver.dim_date,
        "fact_orders": silver.fact_orders,
        "fact_options": silver.fact_options,
    }
    written = {}
    for name, build in builders.items():
        src = read_parquet(spark, _p(bronze_base, BRONZE_TABLES[name]))
        out = _p(silver_base, name)
        df = build(src, order_by=order_by)
        if buckets and name in BUCKETED:
            (
                df.repartition(buckets, *JOIN_KEYS)
                .write.mode("overwrite")
                .bucketBy(buckets, *JOIN_KEYS)
                .sortBy(*JOIN_KEYS)
                .option("path", out)
                .saveAsTable(f"{table_prefix}{name}")
            )
        else:
            write_parquet(df, out)
        log.info("%s written to %s", name, out)
        written[name] = out
    return written


def silver_to_gold(
    spark: SparkSession,
    silver_base: str,
    gold_base: str,
    partition_by_year: bool = False,
    dynamic_overwrite: bool = False,
    bucketed_tables: str | None = None,
) -> dict[str, str]:
    """Build ``fact_customer`` and ``fact_orders_location`` from Silver.

    The enriched order lines feed both outputs; they are stored once in the
    shared checkpoint folder. ``partition_by_year`` writes
    ``fact_orders_location`` partitioned by ``year``. Both tables are rebuilt
    in full, so a year that the source no longer has goes;
    ``dynamic_overwrite`` replaces only the years present instead.
    ``bucketed_tables`` (the table prefix used by ``bronze_to_silver``) reads
    the bucketed Silver catalog tables instead of the folders.
    """
    configure(spark)
    if bucketed_tables is not None:
        # catalog tables written by bronze_to_silver(buckets=...): co-located join
        orders = spark.table(f"{bucketed_tables}fact_orders")
        options = spark.table(f"{bucketed_tables}fact_options")
    else:
        orders = read_parquet(spark, _p(silver_base, "fact_orders"))
        options = read_parquet(spark, _p(silver_base, "fact_options"))
    enriched = materialize(gold.enrich_orders(orders, options))
    customer_path = _p(gold_base, "fact_customer")
    write_parquet(gold.fact_customer(enriched), customer_path)
    location_path = _p(gold_base, "fact_orders_location")
    write_parquet(
        gold.fact_orders_location(enriched),
        location_path,
        partition_by=["year"] if partition_by_year else None,
        dynamic_overwrite=dynamic_overwrite,
    )
    return {"fact_customer": customer_path, "fact_orders_location": location_path}


def main(argv: Sequence[str] | None = None) -> int:
    """Command line (``python -m basketry.plans.jobs`` or, with the package
    shipped via ``--py-files``, ``spark-submit basketry/plans/jobs.py``)::

        jobs.py silver --bronze s3://…/raw/ --silver s3://…/silver/
        jobs.py gold --silver s3://…/silver/ --gold s3://…/gold/
        jobs.py ingest --url jdbc:… --target s3://…/raw/ \\
            --user U --password-env DB_PASSWORD --driver com.example.Driver
    """
    import argparse
    import os

    from basketry.session import build_session
    from basketry.sources.jdbc import ingest_all

    parser = argparse.ArgumentParser(prog="basketry.plans.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    s = sub.add_parser("silver", help="Bronze -> Silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--deterministic", action="store_true", help="dedupe survivors by all columns")
    s.add_argument("--buckets", type=int, help="also register fact tables bucketed by the join keys")
    s.add_argument("--table-prefix", default="silver_")
    g = sub.add_parser("gold", help="Silver -> Gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--partition-by-year", action="store_true")
    g.add_argument("--dynamic-overwrite", action="store_true", help="replace only the years present")
    g.add_argument("--bucketed-tables", metavar="PREFIX", help="read bucketed Silver tables")
    i = sub.add_parser("ingest", help="database -> Bronze")
    i.add_argument("--url", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--user")
    i.add_argument("--password-env", help="name of the environment variable holding the password")
    i.add_argument("--driver")
    i.add_argument("--tables", nargs="+", metavar="SCHEMA.TABLE", help="default: all that the catalog query lists")
    i.add_argument("--catalog-query", help="derived table with a schema and a name column")
    i.add_argument("--schema-column", default="TABLE_SCHEMA")
    i.add_argument("--name-column", default="TABLE_NAME")
    i.add_argument(
        "--partition-column", action="append", default=[], metavar="SCHEMA.TABLE=COLUMN",
        help="numeric column for a parallel read (repeatable)",
    )
    i.add_argument("--partitions", type=int, default=16, help="ranges per parallel read")
    i.add_argument("--concurrent-tables", type=int, default=1)
    i.add_argument("--balanced", action="store_true", help="ranges of equally many rows, by primary key where no column is named")
    args = parser.parse_args(argv)

    spark = build_session(app_name=f"basketry-{args.job}")
    if args.job == "silver":
        bronze_to_silver(
            spark, args.bronze, args.silver,
            order_by="all" if args.deterministic else None,
            buckets=args.buckets, table_prefix=args.table_prefix,
        )
    elif args.job == "gold":
        silver_to_gold(
            spark, args.silver, args.gold,
            partition_by_year=args.partition_by_year, dynamic_overwrite=args.dynamic_overwrite,
            bucketed_tables=args.bucketed_tables,
        )
    else:
        password = os.environ.get(args.password_env) if args.password_env else None
        catalog = {"catalog_query": args.catalog_query} if args.catalog_query else {}
        status = ingest_all(
            spark, args.url, args.target, tables=args.tables,
            partition_columns=dict(x.split("=", 1) for x in args.partition_column),
            num_partitions=args.partitions, schema_column=args.schema_column, name_column=args.name_column,
            concurrent_tables=args.concurrent_tables, balanced=args.balanced, user=args.user, password=password, driver=args.driver, **catalog,
        )
        failed = status.where("status != 'ok'").count()
        status.show(truncate=False)
        return 1 if failed else 0
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
