"""Schema merging for tables whose columns grow over time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StructField,
    StructType,
    VariantType,
)

INTEGERS = (ByteType, ShortType, IntegerType, LongType)


class SchemaChangeError(ValueError):
    """A column came back with another type."""


def nullable(data_type: DataType) -> DataType:
    """The same type with every level nullable, as Parquet files are read back."""
    if isinstance(data_type, StructType):
        return StructType(
            [StructField(f.name, nullable(f.dataType), True, f.metadata) for f in data_type.fields]
        )
    if isinstance(data_type, ArrayType):
        return ArrayType(nullable(data_type.elementType), True)
    if isinstance(data_type, MapType):
        return MapType(nullable(data_type.keyType), nullable(data_type.valueType), True)
    return data_type


def holds_map(data_type: DataType) -> bool:
    """Whether Spark can't hash values of the type."""
    if isinstance(data_type, StructType):
        return any(holds_map(f.dataType) for f in data_type.fields)
    if isinstance(data_type, ArrayType):
        return holds_map(data_type.elementType)
    return isinstance(data_type, (MapType, VariantType))


def is_narrower(new: DataType, old: DataType) -> bool:
    """Whether every value of the new type is one of the old, wider number type."""
    if isinstance(new, INTEGERS) and isinstance(old, INTEGERS):
        return INTEGERS.index(type(new)) < INTEGERS.index(type(old))
    if isinstance(new, DecimalType) and isinstance(old, DecimalType):
        return new.scale <= old.scale and new.precision - new.scale <= old.precision - old.scale
    return isinstance(new, FloatType) and isinstance(old, DoubleType)


def merge_types(old: DataType, new: DataType, where: str = "", widen: bool = False) -> DataType:
    """Union of two types: old fields first, new fields after them; other changes of a type are an error.

    A column keeps its type if the new data has narrower numbers, at any depth. With ``widen`` it takes the
    type of wider numbers. Names are matched without regard to case, as Spark resolves them.
    """
    if isinstance(old, StructType) and isinstance(new, StructType):
        incoming = {f.name.lower(): f for f in new.fields}
        fields = []
        for field in old.fields:
            match = incoming.pop(field.name.lower(), None)
            merged = field.dataType
            if match is not None:
                merged = merge_types(field.dataType, match.dataType, f"{where}.{field.name}".lstrip("."), widen)
            fields.append(StructField(field.name, merged, True, field.metadata))
        return StructType(fields + list(incoming.values()))
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merge_types(old.elementType, new.elementType, f"{where}.element", widen), True)
    if isinstance(old, MapType) and isinstance(new, MapType):
        return MapType(
            merge_types(old.keyType, new.keyType, f"{where}.key", widen),
            merge_types(old.valueType, new.valueType, f"{where}.value", widen),
            True,
        )
    if old == new or is_narrower(new, old):
        return old
    if widen and is_narrower(old, new):
        return new
    raise SchemaChangeError(
        f"column {where} is {old.simpleString()} in the table and {new.simpleString()} in the new data"
    )


def conformed(value: Column, own: DataType, wanted: DataType) -> Column:
    """A value of one type as a value of a merged type: fields it has not got are NULL, numbers are cast, at any depth."""
    if own == wanted:
        return value
    if isinstance(wanted, StructType):
        there = {f.name.lower(): f for f in own.fields}
        parts = []
        for field in wanted.fields:
            match = there.get(field.name.lower())
            part = F.lit(None).cast(field.dataType)
            if match is not None:
                part = conformed(value.getField(match.name), match.dataType, field.dataType)
            parts.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, ArrayType):
        return F.transform(value, lambda x: conformed(x, own.elementType, wanted.elementType))
    if isinstance(wanted, MapType):
        if own.keyType != wanted.keyType:
            value = F.transform_keys(value, lambda k, _: conformed(k, own.keyType, wanted.keyType))
        return F.transform_values(value, lambda _, v: conformed(v, own.valueType, wanted.valueType))
    return value.cast(wanted)
