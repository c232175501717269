"""The least type that holds the values of two types, for remembered schemas that grow.

Whole numbers widen to longer ones and to decimals, short ones to doubles;
floats to doubles; decimals to larger ones; dates to timestamps without zone.
Arrays, maps and structs widen in their parts; a struct keeps the fields that
are known. Types without a common one, text beside numbers for instance, or a
long beside a double, which would lose digits, have none.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

#: Whole numbers by size, with the digits they may have.
WHOLE = [(T.ByteType(), 3), (T.ShortType(), 5), (T.IntegerType(), 10), (T.LongType(), 20)]
#: Whole numbers up to this place in ``WHOLE`` are doubles without loss.
EXACT_IN_DOUBLE = 2
LONGEST = 38


def _place(kind: T.DataType) -> int | None:
    return next((i for i, (whole, _) in enumerate(WHOLE) if whole == kind), None)


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    place = _place(kind)
    return None if place is None else T.DecimalType(WHOLE[place][1], 0)


def common_type(known: T.DataType, found: T.DataType) -> T.DataType | None:
    """The least type that holds both; None if there is none."""
    if known == found:
        return known
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        there = {f.name.lower(): f.dataType for f in found.fields}
        kinds = [common_type(f.dataType, there.get(f.name.lower(), f.dataType)) for f in known.fields]
        if None in kinds:
            return None
        return T.StructType([T.StructField(f.name, k, True) for f, k in zip(known.fields, kinds)])
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        element = common_type(known.elementType, found.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(known, T.MapType) and isinstance(found, T.MapType):
        value = common_type(known.valueType, found.valueType)
        return None if value is None or known.keyType != found.keyType else T.MapType(known.keyType, value)
    one, other = _place(known), _place(found)
    if one is not None and other is not None:
        return WHOLE[max(one, other)][0]
    kinds = {type(known), type(found)}
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds & {T.FloatType, T.DoubleType} and max(-1 if one is None else one, -1 if other is None else other) in range(EXACT_IN_DOUBLE + 1):
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    first, second = _as_decimal(known), _as_decimal(found)
    if first is not None and second is not None:
        scale = max(first.scale, second.scale)
        digits = max(first.precision - first.scale, second.precision - second.scale) + scale
        return T.DecimalType(digits, scale) if digits <= LONGEST else None
    return None


def widened(known: T.StructType, found: T.StructType) -> T.StructType:
    """``known`` with every column as wide as the found one of its name needs, where both have a common type."""
    there = {f.name.lower(): f.dataType for f in found.fields}
    fields = []
    for f in known.fields:
        kind = common_type(f.dataType, there.get(f.name.lower(), f.dataType))
        fields.append(f if kind is None else T.StructField(f.name, kind, f.nullable))
    return T.StructType(fields)


def known_part(value: Column, found: T.DataType, known: T.DataType) -> Column:
    """What of ``value`` the known type can hold; NULL where there is no common type."""
    if found.simpleString() == known.simpleString():
        return value
    if isinstance(found, T.StructType) and isinstance(known, T.StructType):
        there = {f.name: f.dataType for f in found.fields}
        fields = [
            known_part(value[f.name], there[f.name], f.dataType).alias(f.name)
            if f.name in there
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in known.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(found, T.ArrayType) and isinstance(known, T.ArrayType):
        return F.transform(value, lambda v: known_part(v, found.elementType, known.elementType))
    if isinstance(found, T.MapType) and isinstance(known, T.MapType) and found.keyType == known.keyType:
        return F.transform_values(value, lambda _, v: known_part(v, found.valueType, known.valueType))
    if common_type(known, found) == known:
        return value.cast(known)
    return F.lit(None).cast(known)


def holds_all(found: T.DataType, known: T.DataType) -> bool:
    """Whether ``known_part`` loses nothing."""
    if isinstance(found, T.StructType) and isinstance(known, T.StructType):
        there = {f.name: f.dataType for f in known.fields}
        return all(f.name in there and holds_all(f.dataType, there[f.name]) for f in found.fields)
    if isinstance(found, T.ArrayType) and isinstance(known, T.ArrayType):
        return holds_all(found.elementType, known.elementType)
    if isinstance(found, T.MapType) and isinstance(known, T.MapType):
        return found.keyType == known.keyType and holds_all(found.valueType, known.valueType)
    return found.simpleString() == known.simpleString() or common_type(known, found) == known
