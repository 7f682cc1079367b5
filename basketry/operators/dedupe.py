"""Duplicate handling: key dedupe, full-row dedupe, duplicate and key reports.

All of these are hash aggregations, so Spark combines map-side before the
shuffle: a key (or a group of identical rows) holding a large share of the
data is collapsed to one candidate per map task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_on_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | str | None = None,
) -> DataFrame:
    """Keep one row per key; NULL keys are equal to each other.

    ``order_by=None`` keeps an arbitrary survivor (``dropDuplicates``).
    Otherwise the survivor is the row with the smallest ``order_by`` tuple
    (ascending, NULLs first); ``"all"`` means every non-key column in schema
    order, which makes the survivor unique up to fully equal rows.

    The deterministic form is ``min(struct(order…, rest…))`` per key rather
    than ``row_number()`` over a window: the aggregate is partial on the map
    side, so a hot key never lands in one task as a whole.
    """
    keys = list(keys)
    if order_by is None:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    order = rest if order_by == "all" else [c for c in order_by]
    if not rest:
        return df.select(*keys).distinct()
    # Struct fields: the order columns first (they decide the minimum), then
    # the other values; a column that is both is carried once.
    extra = [c for c in rest if c not in order]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    fields += [F.col(c).alias(f"_v{i}") for i, c in enumerate(extra)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"))
    value_of = {c: F.col(f"_best._o{order.index(c)}") for c in rest if c in order}
    value_of.update({c: F.col(f"_best._v{i}") for i, c in enumerate(extra)})
    return best.select(*[F.col(c) if c in keys else value_of[c].alias(c) for c in df.columns])


def duplicate_rows(df: DataFrame, count_col: str = "extra_copies") -> DataFrame:
    """Rows that occur more than once, with how many copies beyond the first.

    Equal rows are indistinguishable, so "the 2nd and later copies" is
    reported as one row per distinct duplicated row plus a count; no group is
    ever expanded inside a single task.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(*cols, (F.col("_n") - 1).alias(count_col))
    )


def duplicate_row_copies(df: DataFrame) -> DataFrame:
    """Every copy of a row after its first, as rows.

    Equal rows are counted first and unfolded from that count, so no group of
    copies meets in one task.
    """
    counted = duplicate_rows(df, "_copies")
    return counted.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).select(*[F.col(f"`{c}`") for c in df.columns])


# Bits of the filter below: 32 MB in all, whatever the input.
FILTER_BITS = 28
_WORD = 15  # bits of one filter row: 4 KB


def row_digests(df: DataFrame) -> list[Column]:
    """Two 64-bit digests of a row; equal rows have equal ones."""
    cells = [F.col(f"`{c}`") for c in df.columns]
    # hashes skip NULLs, so which cells are NULL is hashed too
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cells])
    return [F.xxhash64(*cells, nulls), F.xxhash64(F.lit(len(cells)), nulls, *reversed(cells))]


def split_by_digest(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may repeat, rows that certainly do not); neither shuffles a whole row.

    Only two 64-bit digests per row are shuffled, and counted. The digests
    found more than once set bits in a filter of 2^28 bits; it is sent to all
    tasks, which is safe as its size is fixed, and tested where the rows are
    read. Every repeated row has its bit set. Rows that share a bit by chance
    (about one in a hundred at 2.7 million distinct repeated rows) only add to
    the first part: what counts is decided on whole rows there. ``df`` is read
    twice and must give the same rows both times.
    """
    a, b = row_digests(df)
    repeated = df.select(a.alias("_a"), b.alias("_b")).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    place = F.shiftrightunsigned("_a", 64 - FILTER_BITS)
    bits = (
        repeated.select(F.shiftright(place, _WORD).alias("_word"), place.bitwiseAND(F.lit((1 << _WORD) - 1)).alias("_bit"))
        .groupBy("_word")
        .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    own = df.withColumn("_a", a).withColumn("_place", place)
    own = own.withColumn("_word", F.shiftright("_place", _WORD)).withColumn("_bit", F.col("_place").bitwiseAND(F.lit((1 << _WORD) - 1)))
    tested = own.join(F.broadcast(bits), "_word", "left")
    byte = F.substring("_bits", (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.coalesce(value.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (F.col("_bit") % 8 + 1).cast("int"))) != 0, F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return tested.where(is_set).select(*columns), tested.where(~is_set).select(*columns)


def duplicate_rows_by_digest(df: DataFrame, count_col: str = "extra_copies") -> DataFrame:
    """:func:`duplicate_rows` for wide rows of which few repeat: only rows that may repeat are shuffled whole."""
    return duplicate_rows(split_by_digest(df)[0], count_col)


def distinct_by_digest(df: DataFrame) -> DataFrame:
    """``df.distinct()`` for wide rows of which few repeat: all others stay where they are read."""
    maybe, single = split_by_digest(df)
    return maybe.distinct().unionByName(single)


def distinct_accounting_by_digest(df: DataFrame) -> DataFrame:
    """Rows before, after and removed by dropping fully equal rows, from digests and the rows that may repeat."""
    extra = duplicate_rows_by_digest(df, "_extra").select(F.lit(0).cast("bigint").alias("_rows"), "_extra")
    rows = df.agg(F.count(F.lit(1)).alias("_rows")).select("_rows", F.lit(0).cast("bigint").alias("_extra"))
    return rows.unionByName(extra).agg(F.sum("_rows").alias("_rows"), F.sum("_extra").alias("_extra")).select(
        F.col("_rows").alias("rows_before"),
        (F.col("_rows") - F.col("_extra")).alias("rows_after"),
        F.col("_extra").alias("rows_removed"),
    )


KEY_PARTS = 64  # parts that the rows of one key are dealt to


def key_violation_rows(df: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """The second and later rows of every key (NULL counts as a value).

    Rows of a key are ordered by all other columns in schema order, NULLs
    first. Equal rows are counted, and the rows of a key are dealt to
    ``KEY_PARTS`` parts by their values; only the first row of each part
    meets those of the other parts, so a key that holds a third of the rows is
    never gathered. ``unique`` vouches that no two rows are equal (after
    ``distinct()``), and spares the count.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    counted = df.withColumn("_n", F.lit(1)) if unique else df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    if rest:
        order = [F.col(c).asc_nulls_first() for c in rest]
        dealt = counted.withColumn("_part", F.pmod(F.xxhash64(*rest), F.lit(KEY_PARTS)))
        leads = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)) == 1
        dealt = dealt.withColumn("_leads", leads).withColumn("_part", F.when(F.col("_leads"), F.lit(-1)).otherwise(F.col("_part")))
        place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
        first = F.col("_leads") & (place == 1)
        counted = dealt.withColumn("_later", F.col("_n") - F.when(first, 1).otherwise(0))
    else:
        counted = counted.withColumn("_later", F.col("_n") - 1)
    out = counted.where("_later > 0")
    if not unique:
        out = out.withColumn("_later", F.explode(F.sequence(F.lit(1).cast("bigint"), "_later")))
    return out.select(*df.columns)


def key_violations(df: DataFrame, keys: Sequence[str], count_col: str = "rows") -> DataFrame:
    """Key values (NULL counts as a value) held by more than one row."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count_col))
        .where(F.col(count_col) > 1)
    )


def is_key_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """True if no key value repeats (one small action)."""
    return key_violations(df, keys).limit(1).count() == 0


def dedupe_accounting(before: DataFrame, after: DataFrame) -> DataFrame:
    """One-row frame: rows before, after and removed by a cleaning step.

    Both counts come from one global aggregate over a tagged union (no join).
    """
    tagged = before.select(F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    return tagged.agg(
        F.sum("_b").cast("bigint").alias("rows_before"),
        F.sum("_a").cast("bigint").alias("rows_after"),
    ).select(
        F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
        F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        F.coalesce(F.col("rows_before") - F.col("rows_after"), F.lit(0)).alias("rows_removed"),
    )
