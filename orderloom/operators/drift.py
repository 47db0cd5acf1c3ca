"""What payloads hold, and where two loads or connectors differ in it."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIFT = "`{by}` string, path string, before string, after string, change string"


def payload_schema(df: DataFrame, name: str, by: str) -> dict[str | None, dict[str, str]]:
    """Per value of ``by``: the paths that the payloads in ``name`` (JSON text, VARIANT, arrays or structs) hold, with their types.

    One aggregate with partial merges; what comes back is a schema per group, whatever the size of the feed. A malformed text has no paths; all numbers are
    ``NUMBER``, values of several types under one path ``VARIANT``, JSON nulls alone ``VOID``.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        payload = F.try_parse_json(F.col(name))
    else:
        payload = F.col(name) if isinstance(kind, T.VariantType) else F.to_variant_object(F.col(name))
    found = df.groupBy(F.col(by).cast("string").alias("by")).agg(F.schema_of_variant_agg(payload).alias("schema"))
    return {r["by"]: dict(_paths(r["schema"], "$")) for r in found.collect()}


def payload_drift(before: DataFrame, after: DataFrame, name: str, by: str = "brand") -> DataFrame:
    """Paths that are ``new``, ``lost`` or ``retyped`` in ``after``, per value of ``by`` that both have: ``by``, ``path``, ``before``, ``after``, ``change``."""
    old, new = payload_schema(before, name, by), payload_schema(after, name, by)
    rows = []
    for group in sorted(old.keys() & new.keys(), key=str):
        for path in sorted(old[group].keys() | new[group].keys()):
            was, now = old[group].get(path), new[group].get(path)
            if was != now:
                rows.append((group, path, was, now, "new" if was is None else "lost" if now is None else "retyped"))
    return before.sparkSession.createDataFrame(rows, DRIFT.format(by=by))


def _paths(schema: str | None, at: str) -> Iterator[tuple[str, str]]:
    """Paths of a schema as Spark tells it, with the type at their ends; ``[*]`` for the elements of an array."""
    if schema is None:
        return
    yield from _ends(T._parse_datatype_string(schema.replace("OBJECT<", "STRUCT<")), at)


def _ends(kind: T.DataType, at: str) -> Iterator[tuple[str, str]]:
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from _ends(field.dataType, f"{at}.{field.name}")
    elif isinstance(kind, T.ArrayType):
        yield from _ends(kind.elementType, f"{at}[*]")
    else:
        # Widths follow the values at hand, so numbers are one type.
        yield at, "NUMBER" if isinstance(kind, T.NumericType) else kind.simpleString().upper()
