"""Union of Parquet files whose columns differ in type.

Loads of one table drift: a key is a 32-bit number in one file, a 64-bit one in
the next and text in a third. Spark merges files whose columns are missing, not
files whose types disagree. Here the files fall into groups that Spark can
merge (found from their footers, which Spark reads in parallel), each group is
one scan with its own types, and every column is cast to the narrowest type
that holds the values of all groups:

* whole numbers widen to the widest, also into a decimal that has their digits;
* ``float`` widens to ``double``; whole numbers of up to 32 bits become
  ``double`` where one group has that;
* 64-bit numbers or decimals beside floating point become ``double`` too, and
  the read fails, naming the column, if a value does not survive that
  (``exact=False`` skips this check, which looks at columns, not inside nested
  ones);
* a date beside a timestamp becomes a timestamp;
* structs, arrays and maps are widened inside;
* all else, text included, becomes text; bytes beside text become bytes.

A column that a group lacks is NULL there. Names are compared without case, the
first spelling counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# decimal digits that hold every value of a whole-number type, narrowest first
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
FLOATING = (T.FloatType(), T.DoubleType())
NESTED = (T.StructType, T.ArrayType, T.MapType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for the values of both; ValueError for a nested type beside another kind."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), True)
    if isinstance(a, NESTED) or isinstance(b, NESTED):
        raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.__getitem__)
    digits = [_digits(t) for t in (a, b)]
    if all(digits):
        scale = max(s for _, s in digits)
        whole = max(p - s for p, s in digits)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if all(d or t in FLOATING for d, t in zip(digits, (a, b))):
        return T.DoubleType()
    if {a, b} == {T.DateType(), T.TimestampType()}:
        return T.TimestampType()
    if {a, b} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return T.BinaryType() if T.BinaryType() in (a, b) else T.StringType()


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """(precision, scale) of an exact number type."""
    if t in WHOLE:
        return WHOLE[t], 0
    return (t.precision, t.scale) if isinstance(t, T.DecimalType) else None


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Columns of all schemas in order of appearance, each with its common type."""
    found: dict[str, T.StructField] = {}
    for field in (f for s in schemas for f in s.fields):
        known = found.get(field.name.lower())
        kind = common_type(known.dataType, field.dataType) if known else field.dataType
        found[field.name.lower()] = T.StructField(known.name if known else field.name, kind, True)
    return T.StructType(list(found.values()))


def convert(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """``c`` as ``target``; fields of structs are matched by name, missing ones are NULL."""
    if source == target:
        return c
    if isinstance(target, T.StructType):
        have = {f.name.lower(): f for f in source.fields}
        parts = []
        for f in target.fields:
            old = have.get(f.name.lower())
            part = convert(c[old.name], old.dataType, f.dataType) if old else F.lit(None).cast(f.dataType)
            parts.append(part.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(target, T.ArrayType):
        return F.transform(c, lambda x: convert(x, source.elementType, target.elementType))
    if isinstance(target, T.MapType):
        pairs = F.transform(
            F.map_entries(c),
            lambda e: F.struct(
                convert(e["key"], source.keyType, target.keyType).alias("key"),
                convert(e["value"], source.valueType, target.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(pairs)
    if isinstance(target, T.BinaryType):
        c = c.cast("string")
    return c.cast(target)


def schema_groups(
    spark: SparkSession, files: Sequence[str], base: Mapping[str, str] | None = None, threads: int = 8
) -> list[tuple[T.StructType, list[str]]]:
    """(schema, files): files whose footers agree on the type of every column they share.

    Spark merges the footers of a run of files in one parallel job; a run that
    does not merge is halved. A run has as many files as the cluster has cores,
    so each task reads one footer and a mismatch shows on the driver, where it
    fails no task. Files are taken in path order, where loads lie together: the
    jobs grow with files over cores, plus the logarithm of a run per change of
    type along that order. Runs of equal types then become one group; only
    names and schemas reach the driver.
    """
    reader = spark.read.options(**(base or {}))

    def split(part: list[str]) -> list[tuple[T.StructType, list[str]]]:
        try:
            return [(reader.option("mergeSchema", "true").parquet(*part).schema, part)]
        except (PySparkException, Py4JJavaError) as e:
            if len(part) == 1 or "CANNOT_MERGE" not in str(e):
                raise
        half = len(part) // 2
        return split(part[:half]) + split(part[half:])

    files = sorted(files)
    step = max(1, spark.sparkContext.defaultParallelism)
    with ThreadPoolExecutor(threads) as pool:
        runs = [r for rs in pool.map(split, [files[i : i + step] for i in range(0, len(files), step)]) for r in rs]
    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, part in runs:
        for i, (known, members) in enumerate(groups):
            merged = _same_types(known, schema)
            if merged is not None:
                groups[i] = (merged, members + part)
                break
        else:
            groups.append((schema, list(part)))
    return groups


def _same_types(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Both schemas as one if every top-level column they share has one type and spelling, else None."""
    have = {f.name.lower(): f for f in a.fields}
    for f in b.fields:
        old = have.get(f.name.lower())
        if old is not None and (old.name != f.name or old.dataType != f.dataType):
            return None
    return T.StructType(a.fields + [f for f in b.fields if f.name.lower() not in have])


def read_drifted(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, T.DataType | str] | None = None,
    exact: bool = True,
) -> DataFrame:
    """All files under ``path`` as one DataFrame of common types; one scan per group of equal types.

    ``types`` sets the type of single columns instead of the common one. Filters
    and column pruning reach every scan. Partition columns keep the types that
    Spark finds over all folders. With ``exact`` one aggregate per group reads
    the 64-bit and decimal columns that become ``double`` and raises ValueError
    if one of their values would change; no other case reads rows.
    """
    paths = [path] if isinstance(path, str) else list(path)
    base = {"basePath": paths[0]} if len(paths) == 1 and not any(ch in paths[0] for ch in "*?[{") else {}
    listed = spark.read.options(**base).schema(T.StructType([])).parquet(*paths)
    folders = listed.schema.fields
    files = [unquote(f) for f in listed.inputFiles()]
    if not files:
        raise ValueError(f"no Parquet files under {paths}")
    names = {f.name.lower() for f in folders}
    groups = [
        (T.StructType([f for f in schema.fields if f.name.lower() not in names] + folders), members)
        for schema, members in schema_groups(spark, files, base)
    ]
    target = common_schema([schema for schema, _ in groups])
    given = {k.lower(): T.DataType.fromDDL(v) if isinstance(v, str) else v for k, v in (types or {}).items()}
    if unknown := set(given) - {f.name.lower() for f in target.fields}:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    target = T.StructType([T.StructField(f.name, given.get(f.name.lower(), f.dataType), True) for f in target.fields])
    frames = []
    for schema, members in groups:
        scan = spark.read.options(**base).schema(schema).parquet(*members)
        if exact:
            _check_exact(scan, target)
        have = {f.name.lower(): f for f in schema.fields}
        cells = []
        for f in target.fields:
            old = have.get(f.name.lower())
            cell = convert(scan[f"`{old.name}`"], old.dataType, f.dataType) if old else F.lit(None).cast(f.dataType)
            cells.append(cell.alias(f.name))
        frames.append(scan.select(*cells))
    return reduce(DataFrame.union, frames)


def _check_exact(scan: DataFrame, target: T.StructType) -> None:
    """Raises if a 64-bit or decimal value of ``scan`` changes in a column that becomes floating point."""
    wanted = {f.name.lower(): f.dataType for f in target.fields}
    risky = [
        f for f in scan.schema.fields
        if wanted[f.name.lower()] == T.DoubleType() and (f.dataType == T.LongType() or isinstance(f.dataType, T.DecimalType))
    ]
    if not risky:
        return
    lost = []
    for i, f in enumerate(risky):
        cell = scan[f"`{f.name}`"]
        if f.dataType == T.LongType():
            # the two ends of the range round up to 2^63, which no bigint holds
            bad = cell.cast("decimal(20,0)") != cell.cast("double").cast("decimal(20,0)")
        else:
            bad = cell != cell.cast("double").cast(f.dataType)
        lost.append(F.count_if(bad).alias(f"c{i}"))
    row = scan.agg(*lost).first()
    names = [f"{f.name} ({row[i]} values)" for i, f in enumerate(risky) if row[i]]
    if names:
        raise ValueError(f"not exact as double: {', '.join(names)}; give their types, or exact=False")
