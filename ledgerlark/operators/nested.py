"""Arrays of structs: explode, rebuild, test and normalise, inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import quantise


def unnest(df: DataFrame, array: str, alias: str, outer: bool = False) -> DataFrame:
    """One row per element; ``outer`` keeps parents without elements."""
    explode = F.explode_outer if outer else F.explode
    return df.withColumn(alias, explode(array))


def unnest_chain(df: DataFrame, *steps: tuple[str, str]) -> DataFrame:
    """Outer explode of one array after another: [('a.items', 'item'), ('item.parts', 'part')]."""
    for array, alias in steps:
        df = df.withColumn(alias, F.explode_outer(F.col(array)))
    return df


def first_element(array: Column) -> Column:
    return F.get(array, F.lit(0))


def any_nested(outer: Column, inner: str, test) -> Column:
    """True when any element of any inner array passes the test; null arrays hold nothing."""
    return F.coalesce(F.exists(outer, lambda g: F.coalesce(F.exists(g[inner], test), F.lit(False))), F.lit(False))


def rebuild(array: Column, **fields) -> Column:
    """Same elements with fields set: name -> function of the element."""
    def one(element: Column) -> Column:
        for name, make in fields.items():
            element = element.withField(name, make(element))
        return element
    return F.transform(array, one)


def dominant_value(values: Column) -> Column:
    """Most frequent text of an array; ties go to the earliest, then to the smaller text.

    Sorts (value, place) pairs and counts runs, all inside the row.
    """
    pairs = F.array_sort(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    none = F.lit(None).cast("string")
    zero = F.lit(0)
    start = F.struct(none.alias("v"), zero.alias("n"), zero.alias("first"),
                     none.alias("best"), zero.alias("best_n"), zero.alias("best_first"))

    def step(acc: Column, x: Column) -> Column:
        same = acc["v"].eqNullSafe(x["v"])
        n = F.when(same, acc["n"] + 1).otherwise(1)
        first = F.when(same, acc["first"]).otherwise(x["i"])
        # values arrive in text order, so on a full tie the earlier one stays
        better = (n > acc["best_n"]) | ((n == acc["best_n"]) & (first < acc["best_first"]))
        return F.struct(x["v"].alias("v"), n.alias("n"), first.alias("first"),
                        F.when(better, x["v"]).otherwise(acc["best"]).alias("best"),
                        F.when(better, n).otherwise(acc["best_n"]).alias("best_n"),
                        F.when(better, first).otherwise(acc["best_first"]).alias("best_first"))

    return F.aggregate(pairs, start, step, lambda acc: acc["best"])


def dominant_values(df: DataFrame, key: str, values: Column, name: str) -> DataFrame:
    """(key, name): the same per key of ``df``, for long arrays.

    Rows are brought together by key before their arrays are taken apart, so each array is shuffled once, whole, and
    its values are counted where they lie.  The number of partitions is given, as joining small ones would go by
    the bytes of the rows, not by the many values they hold.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = df.repartition(partitions, key).select(F.col(key), F.posexplode_outer(values).alias("__at", "__value"))
    counted = words.groupBy(key, "__value").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    return counted.groupBy(key).agg(F.max_by("__value", F.struct("__n", -F.col("__first"))).alias(name))


def conform(col: Column, have: T.StructType, want: T.StructType) -> Column:
    """A struct with the wanted fields: kept, cast, or null of the wanted type."""
    names = set(have.fieldNames())
    fields = []
    for field in want.fields:
        if field.name not in names:
            fields.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = have[field.name].dataType
        fields.append(_conform_value(col[field.name], source, field.dataType).alias(field.name))
    return F.when(col.isNotNull(), F.struct(*fields))


def _conform_value(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return col
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        return conform(col, have, want)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(col, lambda x: _conform_value(x, have.elementType, want.elementType))
    return col.try_cast(want)


def normalise(col: Column, kind: T.DataType) -> Column:
    """Decimals quantised at every depth, null arrays turned into empty ones."""
    if isinstance(kind, T.DecimalType):
        return quantise(col)
    if isinstance(kind, T.StructType):
        if not _touches(kind):
            return col
        fields = [normalise(col[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        inner = F.transform(col, lambda x: normalise(x, kind.elementType)) if _touches(kind.elementType) else col
        return F.coalesce(inner, F.array().cast(_quantised(kind)))
    return col


def normalise_records(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Apply ``normalise`` to every column the schema declares."""
    declared = {f.name: f.dataType for f in schema.fields}
    return df.select(*[normalise(F.col(c), declared[c]).alias(c) if c in declared else F.col(c)
                       for c in df.columns])


def _touches(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_touches(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DecimalType, T.ArrayType))


def _quantised(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, 9)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_quantised(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _quantised(f.dataType)) for f in kind.fields])
    return kind
