"""Documents whose shape changes: kept as variants, read by a declared schema.

A variant holds whatever a document says. Declared fields are taken out of it one by one,
so that a value of another type is null and the rest of its document stays readable; what
the documents say and the schema does not is reported.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Problems of a field: the schema lacks it, or it is not of the declared type.
UNKNOWN, OTHER_TYPE = "unknown", "type"


def as_variant(text: Column) -> Column:
    """JSON text as a variant; null if it does not parse."""
    return F.try_parse_json(text)


def declared(variant: Column, schema: T.StructType) -> Column:
    """The fields of ``schema`` as a struct, null if the variant is no object.

    Fields that are absent or of another type are null. Objects, and objects in arrays,
    are taken field by field at any depth; any other value as a whole.
    """
    fields = []
    for field in schema:
        kind, value = field.dataType, _field(variant, field.name)
        if isinstance(kind, T.StructType):
            taken = declared(value, kind)
        elif _of_objects(kind):
            taken = _each(_elements(value), partial(declared, schema=kind.elementType))
        else:
            taken = F.try_variant_get(value, "$", kind.simpleString())
        fields.append(taken.alias(field.name))
    return F.when(_entries(variant).isNotNull(), F.struct(*fields))


def drift(df: DataFrame, variant: str, schema: T.StructType) -> DataFrame:
    """``path``, ``found``, ``problem`` and ``n``: what documents hold beside ``schema``.

    ``problem`` is ``unknown`` for a field that the schema lacks, and ``type`` for a value
    that cannot be read as declared; JSON's null fits any type. ``found`` is the type
    there. Objects of the schema are searched at any depth, also in arrays (``[*]``);
    what is inside of an unknown field is not. The documents are read once, and at most
    one row per path, type and task is shuffled.
    """
    findings = F.explode(_findings(F.col(variant), schema, "")).alias("f")
    return df.select(findings).groupBy("f.path", "f.found", "f.problem").agg(
        F.count("*").alias("n")
    )


def _findings(variant: Column, schema: T.StructType, path: str) -> Column:
    entries = F.coalesce(_entries(variant), F.map_from_entries(_none("array<struct<k:string,v:variant>>")))
    own = F.transform(
        F.map_entries(entries),
        lambda e: F.struct(
            F.concat(F.lit(path), e.getField("key")).alias("path"),
            F.schema_of_variant(e.getField("value")).alias("found"),
            _problem(e.getField("key"), e.getField("value"), schema).alias("problem"),
        ),
    )
    parts = [F.filter(own, lambda f: f.getField("problem").isNotNull())]
    for field in schema:
        kind, value = field.dataType, _field(variant, field.name)
        if isinstance(kind, T.StructType):
            parts.append(_findings(value, kind, f"{path}{field.name}."))
        elif _of_objects(kind):
            inner = partial(_findings, schema=kind.elementType, path=f"{path}{field.name}[*].")
            elements = F.coalesce(_elements(value), _none("array<variant>"))
            parts.append(F.flatten(_each(elements, inner)))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _each(values: Column, make: Callable[[Column], Column]) -> Column:
    return F.transform(values, lambda value: make(value))


def _problem(key: Column, value: Column, schema: T.StructType) -> Column:
    other = F.lit(False)
    for field in schema:
        other = F.when(key == field.name, _misfit(value, field.dataType)).otherwise(other)
    return F.when(~key.isin(schema.names), UNKNOWN).when(other, OTHER_TYPE)


def _misfit(value: Column, kind: T.DataType) -> Column:
    """Whether a value that is not JSON's null cannot be read, nor an element of it."""
    if isinstance(kind, T.StructType):
        other = _entries(value).isNull()
    elif isinstance(kind, T.ArrayType):
        fits = partial(_misfit, kind=kind.elementType)
        other = F.coalesce(F.exists(_elements(value), lambda v: fits(v)), F.lit(True))
    else:
        other = F.try_variant_get(value, "$", kind.simpleString()).isNull()
    return other & (F.schema_of_variant(value) != "VOID")


def _field(variant: Column, name: str) -> Column:
    for quote in ("'", '"'):
        if quote not in name:
            return F.try_variant_get(variant, f"$[{quote}{name}{quote}]", "variant")
    return F.try_element_at(_entries(variant), F.lit(name))


def _entries(variant: Column) -> Column:
    """The fields of an object as a map; null for any other value."""
    return F.try_variant_get(variant, "$", "map<string,variant>")


def _elements(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "array<variant>")


def _of_objects(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def _none(kind: str) -> Column:
    return F.array().cast(kind)
