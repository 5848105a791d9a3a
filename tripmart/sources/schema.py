"""How the schema of a stored table may grow."""

from __future__ import annotations

from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType

# Type in older files -> types that a read can widen it to.
WIDER: dict[type[DataType], tuple[type[DataType], ...]] = {
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
}


def wider(a: DataType, b: DataType) -> DataType | None:
    """The type that both can be read as, None if there is none."""
    if a == b:
        return a
    if type(b) in WIDER.get(type(a), ()):
        return b
    if type(a) in WIDER.get(type(b), ()):
        return a
    return None


def merged_schema(known: StructType | None, new: StructType, keys: tuple[str, ...]) -> StructType:
    """Columns of ``known``, then those that only ``new`` has, then the partition keys as int.

    A column of both keeps its type or gets the wider of the two; any other change of a
    type is an error.  Names that differ in case only are one column, spelled as it was first.
    """
    fields: dict[str, StructField] = {}
    for schema in (known, new):
        for field in schema.fields if schema is not None else ():
            low = field.name.lower()
            if low in (k.lower() for k in keys):
                continue
            held = fields.get(low)
            kind = field.dataType if held is None else wider(held.dataType, field.dataType)
            if kind is None:
                raise ValueError(
                    f"column {field.name} is {held.dataType.simpleString()} in the table and {field.dataType.simpleString()} in the new rows"
                )
            fields[low] = StructField(field.name if held is None else held.name, kind, True)
    return StructType([*fields.values(), *(StructField(k, IntegerType(), True) for k in keys)])
