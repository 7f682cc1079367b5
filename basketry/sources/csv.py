"""CSV scans and sinks (raw extracts and cleaned exports).

The dialect is that of the notebooks' reader and writer: fields with a comma,
a quote or a line break are quoted, and a quote inside is doubled.

Files with line breaks inside fields are read in parallel: Spark splits them
into physical lines, and a line begins a record when the number of quotes
before it is even. One pass counts the quotes of every split; running sums per
file then tell each split whether it starts inside a field, and a second pass
joins lines to records where they are read. Only the two open ends of a split
travel, to meet the other parts of their record.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Texts that the notebooks' reader takes for a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Texts that the notebooks' reader takes for booleans.
BOOLEAN_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")

DIALECT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# an unquoted empty field is NULL, a quoted one the empty text: the reader tells them apart
# only while its text for NULL is not itself empty
NULL_TEXT = "\u0000"
MAX_SPLITS = 200_000  # most splits whose state is sent to the tasks; more are joined

# What the values of a column were: a set of these bits. Sets merge by "or", in any order.
MISSING, BOOLEAN, INTEGER, NEGATIVE, UNSIGNED, FLOAT, TEXT = (1 << i for i in range(7))
_NUMBERS = INTEGER | NEGATIVE | UNSIGNED | FLOAT


# what a number can begin and end with; the expressions allow for one line end behind it
_NUMBER_STARTS = (*"0123456789", *"+-.iI")
_NUMBER_ENDS = (*"0123456789", *".fFyY", *"\n\r\x85\u2028\u2029")


def value_kind(value: Column) -> Column:
    """The bit of one text; NULL is missing.

    Each expression is matched at most once, and only against texts that begin
    and end like a number.
    """
    trimmed = F.trim(value)
    whole = F.regexp_like(trimmed, F.lit(r"^[+-]?[0-9]+$"))
    small = trimmed.try_cast("bigint")
    real = F.regexp_like(trimmed, F.lit(r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"))
    fits = trimmed.try_cast("decimal(38,0)").between(F.lit("0").cast("decimal(38,0)"), F.lit(str(2**64 - 1)).cast("decimal(38,0)"))
    integer = F.when(small < 0, F.lit(NEGATIVE)).when(small.isNotNull(), F.lit(INTEGER)).when(fits, F.lit(UNSIGNED)).otherwise(F.lit(TEXT))
    like_number = F.substring(trimmed, 1, 1).isin(*_NUMBER_STARTS) & F.substring(trimmed, -1, 1).isin(*_NUMBER_ENDS)
    return (
        F.when(value.isNull(), F.lit(MISSING))
        .when(value.isin(*BOOLEAN_TOKENS), F.lit(BOOLEAN))
        .when(~like_number, F.lit(TEXT))
        .when(whole, integer)
        .when(real, F.lit(FLOAT))
        .otherwise(F.lit(TEXT))
    )


def type_states(df: DataFrame) -> dict[str, int]:
    """The kinds of values in each text column, from one aggregate over one pass."""
    if not df.columns:
        return {}
    row = df.agg(*[F.bit_or(value_kind(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    return {c: row[i] or 0 for i, c in enumerate(df.columns)}


def merge_states(*states: Mapping[str, int]) -> dict[str, int]:
    """States of several loads as one, without reading any again; a column that a load lacks is missing there."""
    names = dict.fromkeys(n for s in states for n in s)
    return {n: reduce(lambda a, s: a | s.get(n, MISSING), states, 0) for n in names}


def state_type(state: int) -> str:
    """The narrowest type that keeps every value: the notebooks' reader's choice, with NULL for missing.

    A mixture with text, or of booleans and numbers, stays text, and so do
    dates and times of day. A column without a value is a double.
    """
    kinds = state & ~MISSING
    if kinds & TEXT or (kinds & BOOLEAN and kinds & _NUMBERS):
        return "string"
    if kinds & BOOLEAN:
        return "boolean"
    if kinds & FLOAT or not kinds:
        return "double"
    if kinds & UNSIGNED:
        return "string" if kinds & NEGATIVE else "decimal(20,0)"
    return "bigint"


def _header(spark: SparkSession, path: str, multiline: bool) -> list[str]:
    """Column names of the file, or of a folder's files: the first record alone is read."""
    return spark.read.options(**DIALECT, header="true", multiLine=str(multiline).lower()).csv(path).columns


def read_records(spark: SparkSession, path: str, max_splits: int = MAX_SPLITS) -> DataFrame:
    """(``record``): the records of CSV files, line breaks inside quoted fields included, without header and blank lines.

    Files are read by as many tasks as Spark makes splits
    (``spark.sql.files.maxPartitionBytes``). Quotes must follow the dialect: a
    field that holds one is quoted, and it is doubled inside.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"')))).cast("long")
    lines = lines.select("value", *place)
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    splits = counts.select("file", "start", inside.alias("inside")).where("inside")
    if splits.count() <= max_splits:
        placed = lines.join(F.broadcast(splits), ["file", "start"], "left")
    else:
        numbered = lines.withColumn("n", F.monotonically_increasing_id())
        placed = numbered.join(splits, ["file", "start"], "left").repartition("file", "start").sortWithinPartitions("file", "start", "n")
    placed = placed.select("value", "file", "start", F.coalesce("inside", F.lit(False)).alias("inside"))
    parts = placed.mapInArrow(_join_lines, "kind int, file string, start long, first boolean, text string")
    ends = parts.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", "kind")  # at most two rows per split
    opened = F.count_if(F.col("kind") == OPENS).over(order)
    pieces = F.sort_array(F.collect_list(F.struct("start", "kind", "text")))["text"]
    joined = ends.withColumn("record", opened).groupBy("file", "record").agg(
        F.array_join(pieces, "\n").alias("text"), F.max("first").alias("first")
    )
    every = parts.where(F.col("kind") == WHOLE).select("text", "first").unionByName(joined.select("text", "first"))
    return every.where(~F.col("first")).select(F.regexp_replace("text", "\r$", "").alias("record")).where("record <> ''")


# parts of records: a whole one; the end of one that an earlier split opened; the middle of such; the open end of a split
WHOLE, CLOSES, PASSES, OPENS = range(4)


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole splits, in order, to records and the open ends of each split."""
    split, held, odd, lead, seen, first = None, [], False, False, 0, False
    ends: list[tuple] = []

    def close() -> None:
        if held:
            ends.append((PASSES if lead else OPENS, *split, first and not lead, "\n".join(held)))

    def rows(kind: list, file: list, start: list, first: list, text: list) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((kind, file, start, first, text), kinds)], names=["kind", "file", "start", "first", "text"])

    for b in batches:
        files, starts = b.column(1).to_pylist(), b.column(2).to_pylist()
        inside = b.column(3).to_pylist()
        quotes = pc.count_substring(b.column(0), '"').to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            if (files[at], starts[at]) != split:
                close()
                split, held, odd, lead, seen = (files[at], starts[at]), [], inside[at], inside[at], 0
            stop = at + 1
            while stop < b.num_rows and starts[stop] == split[1] and files[stop] == split[0]:
                stop += 1
            after = (np.cumsum(quotes[at:stop]) + odd) % 2 == 1
            before = np.concatenate(([odd], after[:-1]))
            plain = ~before & ~after
            whole = pc.take(b.column(0).slice(at, stop - at), pa.array(np.flatnonzero(plain))).to_pylist()
            # the first record of a file is its header
            top = split[1] == 0 and not seen
            header = [top and bool(plain[0])] * bool(whole) + [False] * (len(whole) - 1)
            for i in np.flatnonzero(~plain).tolist():
                if not held:
                    first = top and i == 0
                held.append(b.column(0)[at + i].as_py())
                if not after[i]:  # the record ends here
                    if lead:
                        ends.append((CLOSES, *split, False, "\n".join(held)))
                    else:
                        whole.append("\n".join(held))
                        header.append(first)
                    held, lead = [], False
            odd = bool(after[-1])
            seen += stop - at
            if whole:
                yield rows([WHOLE] * len(whole), [split[0]] * len(whole), [split[1]] * len(whole), header, whole)
            at = stop
    close()
    if ends:
        yield rows(*zip(*ends))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer_schema: bool = False,
    multiline: bool = False,
    missing: Sequence[str] = MISSING_TOKENS,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header row; ``missing`` texts become NULL in every column.

    Columns are text unless ``schema`` gives types (a text that does not fit
    its type fails the job) or ``infer_schema`` finds them in an extra pass
    (:func:`type_states`, :func:`state_type`).

    ``multiline`` allows line breaks inside quoted fields, at the cost of a
    pass that counts quotes (:func:`read_records`). A record with
    too few or too many fields (a line break in a quoted field, when
    ``multiline`` is off) fails the job instead of shifting cells;
    ``corrupt_column`` names a column that collects such records instead.
    """
    names = schema.fieldNames() if schema is not None else _header(spark, path, multiline)
    options = {**DIALECT, "nullValue": NULL_TEXT, "mode": "PERMISSIVE" if corrupt_column else "FAILFAST"}
    if multiline:
        fields = [f"c{i} STRING" for i in range(len(names))] + (["corrupt STRING"] if corrupt_column else [])
        options |= {"columnNameOfCorruptRecord": "corrupt", "multiLine": "true"}
        parsed = read_records(spark, path).select(F.from_csv("record", ", ".join(fields), options).alias("r")).select("r.*")
        raw = parsed.toDF(*names, *([corrupt_column] if corrupt_column else []))
    else:
        fields = [StructField(n, StringType()) for n in names]
        if corrupt_column:
            fields.append(StructField(corrupt_column, StringType()))
            options["columnNameOfCorruptRecord"] = corrupt_column
        raw = spark.read.options(**options, header="true", columnPruning="false").schema(StructType(fields)).csv(path)
    tokens = list(missing)
    text = {n: F.when(~F.col(f"`{n}`").isin(tokens), F.col(f"`{n}`")) if tokens else F.col(f"`{n}`") for n in names}
    extra = [F.col(corrupt_column)] if corrupt_column else []
    if schema is not None:
        return raw.select(*[text[f.name].cast(f.dataType).alias(f.name) for f in schema.fields], *extra)
    clean = raw.select(*[text[n].alias(n) for n in names], *extra)
    if not infer_schema:
        return clean
    return with_types(clean, type_states(clean.select(*[F.col(f"`{n}`") for n in names])))


def with_types(df: DataFrame, states: Mapping[str, int]) -> DataFrame:
    """Text columns cast to the types of their states; other columns stay."""
    return df.select(
        *[F.trim(F.col(f"`{c}`")).cast(t).alias(c) if (t := state_type(states[c]) if c in states else "string") != "string" else F.col(f"`{c}`") for c in df.columns]
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row and no index column, one file per partition.

    NULL is an empty field, the empty text a quoted one; :func:`read_csv` with
    ``missing=()`` tells them apart, the notebooks' reader takes both for
    missing.
    """
    df.write.mode(mode).options(**DIALECT, header="true").csv(path)
