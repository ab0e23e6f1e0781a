"""Column names, audit columns and target schemas."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DataType, DecimalType, DoubleType, NullType, StringType, StructField, StructType

from masterloom.context import RunContext


def sanitized_names(names: Sequence[str]) -> list[str]:
    """Lower-case alphanumeric names, unique and never empty.

    Everything outside ``0-9a-z`` goes after lower-casing.  A name with nothing
    left becomes ``col_{position}``, counted from 1; the second and later uses of
    a name get ``_2``, ``_3`` and so on, in column order.
    """
    seen: dict[str, int] = {}
    out = []
    for position, name in enumerate(names, start=1):
        base = re.sub("[^0-9a-z]", "", name.lower()) or f"col_{position}"
        seen[base] = seen.get(base, 0) + 1
        out.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    """The same table under sanitised column names."""
    return df.toDF(*sanitized_names(df.columns))


def add_audit(df: DataFrame, ctx: RunContext, file_name: str) -> DataFrame:
    """Add file name, who and when, and the batch id of this load."""
    return df.withColumns(
        {
            "filename": F.lit(file_name),
            "createdby": ctx.user_col(),
            "lastupdatedby": ctx.user_col(),
            "createdtimestamp": ctx.ts_col(),
            "lastupdatedtimestamp": ctx.ts_col(),
            "batch_id": F.lit(ctx.batch_id),
        }
    )


def string_schema(names: Iterable[str]) -> StructType:
    """A schema of nullable strings."""
    return StructType([StructField(name, StringType()) for name in names])


class SchemaDriftError(ValueError):
    """Columns whose values the target's types cannot hold."""


# Digits of the integral types, narrowest first.
INTEGRAL_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def keeps_values(source: DataType, target: DataType) -> bool:
    """Whether a cast from one type to the other changes no value."""
    a, b = source.simpleString(), target.simpleString()
    if a == b or isinstance(source, NullType):
        return True
    if b == "string":
        return isinstance(source, AtomicType) and a != "binary"
    if isinstance(target, DecimalType):
        whole, scale = target.precision - target.scale, target.scale
        if isinstance(source, DecimalType):
            return source.precision - source.scale <= whole and source.scale <= scale
        return INTEGRAL_DIGITS.get(a, 99) <= whole
    if a in INTEGRAL_DIGITS:
        wider = {"double": 10, "float": 5}
        return INTEGRAL_DIGITS[a] <= INTEGRAL_DIGITS.get(b, wider.get(b, 0))
    return (a, b) in {("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz")}


def wider_type(first: DataType, second: DataType) -> DataType:
    """The type that holds both types' values: one of them, else a double, a decimal or text.

    A double is taken for integers of up to 10 digits and floats, a decimal for exact
    numbers of up to 38 digits, text for other values that have a text.  Where none holds
    both, ``SchemaDriftError``.
    """
    for source, target in ((second, first), (first, second)):
        if keeps_values(source, target):
            return target
    if keeps_values(first, DoubleType()) and keeps_values(second, DoubleType()):
        return DoubleType()
    exact = [_as_decimal(t) for t in (first, second)]
    if all(exact):
        scale = max(t.scale for t in exact)
        digits = scale + max(t.precision - t.scale for t in exact)
        if digits <= 38:
            return DecimalType(digits, scale)
    if keeps_values(first, StringType()) and keeps_values(second, StringType()):
        return StringType()
    raise SchemaDriftError(f"no type holds the values of {first.simpleString()} and {second.simpleString()}")


def _as_decimal(t: DataType) -> DecimalType | None:
    if isinstance(t, DecimalType):
        return t
    digits = INTEGRAL_DIGITS.get(t.simpleString())
    return DecimalType(digits, 0) if digits else None


def narrowed_columns(df: DataFrame, schema: StructType) -> list[str]:
    """Columns that the target has in a type that cannot hold their values."""
    known = {f.name.lower(): f.dataType for f in schema.fields}
    return [
        f"{f.name}: {f.dataType.simpleString()} to {known[f.name.lower()].simpleString()}"
        for f in df.schema.fields
        if f.name.lower() in known and not keeps_values(f.dataType, known[f.name.lower()])
    ]


def conform(df: DataFrame, schema: StructType, lossless: bool = False) -> DataFrame:
    """The table in the target's columns, order, spelling and types.

    Names match in any case.  A column the table lacks becomes a typed null; one
    the target lacks is left out (``schema_drift`` reports both).  With ``lossless``
    a cast that could change a value raises ``SchemaDriftError`` instead.
    """
    if lossless and (narrowed := narrowed_columns(df, schema)):
        raise SchemaDriftError(f"the table's types cannot hold these columns: {narrowed}")
    present = {name.lower(): name for name in df.columns}

    def column(f: StructField) -> str:
        source = present.get(f.name.lower())
        value = "NULL" if source is None else quoted(source)
        return f"CAST({value} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"

    # Texts, not Column objects: a wide table takes one call per column to the JVM.
    return df.selectExpr([column(f) for f in schema.fields])


def schema_drift(df: DataFrame, schema: StructType) -> dict[str, list[str]]:
    """Columns the target has and the table lacks, and the reverse."""
    have = {name.lower() for name in df.columns}
    want = {name.lower() for name in schema.names}
    return {
        "missing": [name for name in schema.names if name.lower() not in have],
        "extra": [name for name in df.columns if name.lower() not in want],
    }


def merged_schema(schema: StructType, batch: StructType) -> StructType:
    """The schema with the batch's new columns at the end; known ones keep their type."""
    known = {name.lower() for name in schema.names}
    new = [StructField(f.name, f.dataType) for f in batch.fields if f.name.lower() not in known]
    return StructType(schema.fields + new)


def quoted(name: str) -> str:
    """The name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"
