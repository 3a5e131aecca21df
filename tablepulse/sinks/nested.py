"""K6, K7, K9 for nested and widened schemas.

:func:`merge_types` merges two types by name, at any depth: structs take the fields of
both, arrays and maps merge their elements, and a number may widen (int to long,
float to double, smaller decimals to larger ones) but never narrow. What would lose or reinterpret values is
refused with the path of the field. :func:`convert` brings a column from its type
to the merged one by built-in expressions, and :func:`write_nested` appends to a
table whose schema grows: files already written stay as they are, as Parquet readers
give missing fields as null and widen numbers.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: fixed values: numbers that hold every value of the ones before them
WIDER = [
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()],
    [T.FloatType(), T.DoubleType()],
]


class SchemaConflict(ValueError):
    """Two types that cannot be merged without losing values."""


def merge_types(old: T.DataType, new: T.DataType, path: str = "") -> T.DataType:
    """The type that holds the values of both."""
    if isinstance(old, T.NullType):
        return new
    if isinstance(new, T.NullType) or old == new:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return _merge_structs(old, new, path)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merge_types(old.elementType, new.elementType, f"{path}[]"), old.containsNull or new.containsNull)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        if old.keyType != new.keyType:
            raise SchemaConflict(f"{path or 'map'}: keys {old.keyType.simpleString()} and {new.keyType.simpleString()}")
        return T.MapType(old.keyType, merge_types(old.valueType, new.valueType, f"{path}{{}}"), old.valueContainsNull or new.valueContainsNull)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale, whole = max(old.scale, new.scale), max(old.precision - old.scale, new.precision - new.scale)
        if scale + whole <= 38 and old.scale == new.scale:
            return T.DecimalType(scale + whole, scale)
    for order in WIDER:
        if old in order and new in order:
            return order[max(order.index(old), order.index(new))]
    raise SchemaConflict(f"{path or 'value'}: {old.simpleString()} and {new.simpleString()}")


def _merge_structs(old: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """Fields of ``old`` in their order, then those that only ``new`` has. All may be null, as rows of the other side lack some."""
    twice = {f.name.lower() for f in old.fields} & {f.name.lower() for f in new.fields} - {f.name.lower() for f in old.fields if f.name in new.names}
    if twice:
        raise SchemaConflict(f"{path or 'struct'}: names that differ in case only: {sorted(twice)}")
    other = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        kind = merge_types(f.dataType, other[f.name].dataType, f"{path}.{f.name}".lstrip(".")) if f.name in other else f.dataType
        fields.append(T.StructField(f.name, nullable(kind), True))
    fields += [T.StructField(f.name, nullable(f.dataType), True) for f in new.fields if f.name not in set(old.names)]
    return T.StructType(fields)


def nullable(kind: T.DataType) -> T.DataType:
    """The type with every part nullable, as tables store it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, nullable(kind.valueType), True)
    return kind


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    return _merge_structs(old, new)


def convert(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as ``want``, which holds all its values (a result of :func:`merge_types`)."""
    if nullable(have) == nullable(want):
        return value
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        fields = [convert(value.getField(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType) for f in want.fields]
        # a null struct stays null instead of becoming a struct of nulls
        return F.when(value.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(fields, want.fields, strict=True)])).cast(want)
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: convert(x, have.elementType, want.elementType)).cast(want)
    if isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: convert(x, have.valueType, want.valueType)).cast(want)
    return value.cast(want)


def align_nested(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``target``: missing fields, at any depth, as nulls."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[(convert(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields]
    )


def write_nested(spark: SparkSession, fqn: str, df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> T.StructType:
    """Append to a Parquet table in ``path``, whose schema becomes the merge of both; gives that schema.

    A grown schema is noted in ``<path>_schemas`` and then put into the catalog by entering the table anew over the same
    files, which are not touched. A run that dies in between leaves the files complete and the note behind, from which the
    next call enters the table again.
    """
    notes = f"{path.rstrip('/')}_schemas"
    known = spark.catalog.tableExists(fqn)
    noted = None if known else _noted(spark, notes)
    old = spark.table(fqn).schema if known else noted if noted is not None else T.StructType([])
    merged = merge_schemas(old, df.schema)
    changed = set(partition_by) & {f.name for f in merged.fields if f.name in old.names and f.dataType != nullable(old[f.name].dataType)}
    if changed:
        raise SchemaConflict(f"partition columns cannot change: {sorted(changed)}")
    merged = T.StructType([f for f in merged.fields if f.name not in partition_by] + [merged[c] for c in partition_by])
    if not known or nullable(old) != merged:
        note = spark.createDataFrame([(time.time_ns(), merged.json())], "at long, schema string").coalesce(1)
        note.write.mode("append").json(notes)
        spark.sql(f"DROP TABLE IF EXISTS {fqn}")
        columns = ", ".join(f"`{f.name}` {type_text(f.dataType)}" for f in merged.fields)
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {fqn} ({columns}) USING parquet{by} LOCATION '{path}'")
        if partition_by and (known or noted is not None):
            spark.sql(f"ALTER TABLE {fqn} RECOVER PARTITIONS")
    align_nested(df, merged).write.insertInto(fqn)
    return merged


def _noted(spark: SparkSession, notes: str) -> T.StructType | None:
    """The schema of the last note."""
    try:
        last = spark.read.schema("at long, schema string").json(notes).orderBy(F.desc("at")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return None if last is None else T.StructType.fromJson(json.loads(last["schema"]))


def type_text(kind: T.DataType) -> str:
    """A type in SQL, with field names quoted."""
    if isinstance(kind, T.StructType):
        return f"STRUCT<{', '.join(f'`{f.name}`: {type_text(f.dataType)}' for f in kind.fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{type_text(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"MAP<{type_text(kind.keyType)}, {type_text(kind.valueType)}>"
    return kind.simpleString()
