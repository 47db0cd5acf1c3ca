"""Semi-structured values: JSON text, native arrays, and values inside them.

One feed sends arrays as JSON text, another as native ``array<struct>``. Both become an
array column that is read with :class:`Element`, so one projection serves both feeds.
JSON text is parsed once per row, as a VARIANT; a malformed text is NULL, and one odd element
does not spoil its neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"\.([A-Za-z_]\w*)|\[(\d+)\]")


class Element:
    """Reads typed values out of one semi-structured column by JSON path."""

    def __init__(self, col: Column, data_type: T.DataType, strict: bool = False):
        self.col = col
        self.data_type = data_type
        self.strict = strict

    def get(self, path: str, as_type: str) -> Column:
        """The value at ``path`` (``$.a.b[0].c``); NULL when it is absent or not castable."""
        if isinstance(self.data_type, T.VariantType):
            read = F.variant_get if self.strict else F.try_variant_get
            return read(self.col, path, as_type)
        found = _resolve(self.col, self.data_type, path)
        if found is None:
            return F.lit(None).cast(as_type)
        if isinstance(found[1], T.VariantType):
            return (F.variant_get if self.strict else F.try_variant_get)(found[0], found[2], as_type)
        return found[0].cast(as_type) if self.strict else found[0].try_cast(as_type)

    def first_of(self, paths: list[str], as_type: str) -> Column:
        """The first path that holds a value: the object form, then the one-element array."""
        return F.coalesce(*[self.get(p, as_type) for p in paths])

    def structs(self, path: str, fields: Mapping[str, str]) -> Column:
        """The array at ``path`` as structs of ``fields`` (name to type); NULL when absent.

        An element that is no object is NULL, and so is a field that does not cast.
        """
        if isinstance(self.data_type, T.VariantType):
            return F.try_variant_get(self.col, path, _structs_type(fields))
        found = _resolve(self.col, self.data_type, path)
        if found and isinstance(found[1], T.VariantType):
            return F.try_variant_get(found[0], found[2], _structs_type(fields))
        if found is None or not isinstance(found[1], T.ArrayType):
            return F.lit(None).cast(_structs_type(fields))
        return _native_structs(found[0], found[1].elementType, fields)

    def text(self, path: str) -> Column:
        """The array or object at ``path`` as JSON text, whole."""
        if isinstance(self.data_type, T.VariantType):
            return F.try_variant_get(self.col, path, "string")
        found = _resolve(self.col, self.data_type, path)
        if found is None:
            return F.lit(None).cast("string")
        if isinstance(found[1], T.VariantType):
            return F.try_variant_get(found[0], found[2], "string")
        return F.to_json(found[0])


def json_structs(df: DataFrame, name: str, fields: Mapping[str, str]) -> Column:
    """Column ``name``, a JSON text or a native array, as an array of structs of ``fields``."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType):
        return _native_structs(F.col(name), kind.elementType, fields)
    return typed_array(df, name, fields, strict=False)[0]


def json_array(df: DataFrame, name: str, strict: bool = False) -> tuple[Column, T.DataType]:
    """Column ``name`` as an array, with its element type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType):
        return F.col(name), kind.elementType
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(F.col(name), "$", "array<variant>"), T.VariantType()
    if strict:
        return F.variant_get(F.parse_json(F.col(name)), "$", "array<variant>"), T.VariantType()
    return F.try_variant_get(F.try_parse_json(F.col(name)), "$", "array<variant>"), T.VariantType()


def explode_array(
    df: DataFrame,
    name: str,
    element: str = "element",
    outer: bool = False,
    strict: bool = False,
    fields: Mapping[str, str] | None = None,
) -> tuple[DataFrame, Element]:
    """One row per array element, with its position in ``<element>_pos``; ``name`` is dropped.

    With ``fields`` (name to type) JSON elements are read as structs of them in one step, which is
    much cheaper than one path lookup per field; native elements need no such step. Rows are counted
    apart from the structs, so that Spark leaves these out where no field is read, as it does with native ones.
    """
    array, kind = json_array(df, name, strict)
    if fields and isinstance(kind, T.VariantType):
        return _explode_fields(df, name, element, outer, strict, fields)
    explode = F.posexplode_outer if outer else F.posexplode
    rest = [F.col(c) for c in df.columns if c != name]
    rows = df.select(*rest, explode(array).alias(f"{element}_pos", element))
    return rows, Element(F.col(element), kind, strict)


def _explode_fields(
    df: DataFrame, name: str, element: str, outer: bool, strict: bool, fields: Mapping[str, str]
) -> tuple[DataFrame, Element]:
    """:func:`explode_array` of JSON text or a VARIANT read as structs: the positions are exploded and the structs looked up in the row."""
    rest = [c for c in df.columns if c != name]
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        col = F.parse_json(col) if strict else F.try_parse_json(col)
    read = F.variant_get if strict else F.try_variant_get
    parsed = F.col("__parsed")
    size, structs = F.array_size(read(parsed, "$", "array<struct<>>")), read(parsed, "$", _structs_type(fields))
    wide = df.select(*rest, col.alias("__parsed")).select(*rest, size.alias("__size"), structs.alias("__structs"))
    places = F.when(F.col("__size") > 0, F.sequence(F.lit(0), F.col("__size") - 1))
    at = f"{element}_pos"
    rows = wide.select("*", (F.explode_outer if outer else F.explode)(places).alias(at))
    return rows.select(*rest, at, F.get("__structs", F.col(at)).alias(element)), Element(F.col(element), _struct(fields), strict)


def rejected_payloads(df: DataFrame, name: str) -> DataFrame:
    """The rows whose JSON text in ``name`` does not parse: what a tolerant read leaves out.

    NULL texts are not rejected; a native column never is. Of payloads parsed before (:func:`parse_payloads`) those whose text was kept.
    """
    if f"{name}_rejected" in df.columns:
        return df.where(F.col(f"{name}_rejected").isNotNull())
    if not isinstance(df.schema[name].dataType, T.StringType):
        return df.where(F.lit(False))
    return df.where(F.col(name).isNotNull() & F.try_parse_json(F.col(name)).isNull())


def parse_payloads(df: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """``df`` with the JSON texts in ``names`` parsed, once, as VARIANTs; columns it lacks or that are no text stay as they are.

    Written to parquet, a VARIANT's fields are columns of their own that later reads pick by path. A text that does not parse is kept in
    ``<name>_rejected``, or with ``strict`` fails.
    """
    texts = [n for n in names if n in df.columns and isinstance(df.schema[n].dataType, T.StringType)]
    if strict:
        return df.withColumns({n: F.parse_json(n) for n in texts})
    rejected = {f"{n}_rejected": F.when(F.col(n).isNotNull() & F.try_parse_json(n).isNull(), F.col(n)) for n in texts}
    return df.withColumns(rejected).withColumns({n: F.try_parse_json(n) for n in texts})


def typed_payload(df: DataFrame, name: str, fields: Mapping[str, str], strict: bool = False) -> DataFrame:
    """``df`` with a VARIANT in ``name`` as an array of structs of ``fields``; other columns stay. Put right above a scan, it reads these fields alone."""
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.VariantType):
        return df
    return df.withColumn(name, typed_array(df, name, fields, strict)[0])


def parse_head(df: DataFrame, name: str, into: str, strict: bool = False) -> tuple[DataFrame, Element]:
    """Element 0 of the array in ``name`` as column ``into``, parsed once per row."""
    array, kind = json_array(df, name, strict)
    rows = df.withColumn(into, F.get(array, F.lit(0)))
    return rows, Element(F.col(into), kind, strict)


def object_entries(
    df: DataFrame, name: str, key: str = "key", value: str = "value", at: str = "$", strict: bool = False
) -> DataFrame:
    """One row per entry of the object at path ``at`` of ``name`` (VARIANT or JSON text).

    ``value`` stays a VARIANT; ``name`` is dropped. Where there is no object there are no rows.
    """
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        col = F.parse_json(col) if strict else F.try_parse_json(col)
    rest = [F.col(c) for c in df.columns if c != name]
    entries = F.try_variant_get(col, at, "map<string,variant>")
    return df.select(*rest, F.explode(entries).alias(key, value))


def array_sum(structs: Column, field: str) -> Column:
    """Sum of ``field`` over one array of structs; NULL when no element holds a number.

    Works inside the row, so it needs neither an explode nor a shuffle. Give it a column: asked for it twice, Spark keeps
    the step that makes it apart, in generated code, of which functions of arrays are no part.
    """
    none = F.lit(None).cast("double")
    total = F.aggregate(structs[field], none, lambda acc, a: F.coalesce(F.coalesce(acc, F.lit(0.0)) + a, acc))
    return F.when(F.size(structs) > 0, total)


def _structs_type(fields: Mapping[str, str]) -> str:
    return "array<struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">>"


def typed_array(
    df: DataFrame, name: str, fields: Mapping[str, str], strict: bool
) -> tuple[Column, T.DataType]:
    """JSON text or a VARIANT as an array of structs of ``fields`` (name to type), with the struct type."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        col = F.parse_json(col) if strict else F.try_parse_json(col)
    read = F.variant_get if strict else F.try_variant_get
    return read(col, "$", _structs_type(fields)), _struct(fields)


def _struct(fields: Mapping[str, str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields.items()))


def _native_structs(array: Column, kind: T.DataType, fields: Mapping[str, str]) -> Column:
    if kind.simpleString() == _struct(fields).simpleString():
        return array

    def struct(e: Column) -> Column:
        return F.struct(*[Element(e, kind).get(f"$.{n}", t).alias(n) for n, t in fields.items()])

    return F.transform(array, struct)


def _resolve(col: Column, kind: T.DataType, path: str) -> tuple[Column, T.DataType, str] | None:
    """Follow a JSON path through native types, to its end or to a VARIANT and the path left in it; None where the schema has no such path."""
    for step in _STEP.finditer(path):
        field, index = step.groups()
        if isinstance(kind, T.VariantType):
            return col, kind, "$" + path[step.start() :]
        if field and isinstance(kind, T.StructType) and field in kind.names:
            col, kind = col.getField(field), kind[field].dataType
        elif field and isinstance(kind, T.MapType):
            col, kind = F.try_element_at(col, F.lit(field)), kind.valueType
        elif index and isinstance(kind, T.ArrayType):
            col, kind = F.get(col, F.lit(int(index))), kind.elementType
        else:
            return None
    return col, kind, "$"
