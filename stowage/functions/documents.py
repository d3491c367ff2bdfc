"""Nested documents: defaults, canonical collections, map edits, conversion to and from rows."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import ENTITIES


def _literal(value, dtype):
    """A typed literal, including empty maps and lists."""
    if isinstance(dtype, T.MapType):
        return F.from_json(F.lit("{}"), dtype) if not value else F.create_map(
            *[part for k, v in value.items() for part in (F.lit(k), _literal(v, dtype.valueType))])
    if isinstance(dtype, T.ArrayType):
        return F.array(*[_literal(v, dtype.elementType) for v in value]).cast(dtype)
    return F.lit(value).cast(dtype)


def fill_defaults(df: DataFrame, schema: T.StructType, defaults: dict) -> DataFrame:
    """Read documents under a declared schema: absent columns appear, nulls take their default."""
    columns = []
    for field in schema.fields:
        column = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name in defaults:
            column = F.coalesce(column, _literal(defaults[field.name], field.dataType))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def from_documents(df: DataFrame, column: str, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """JSON documents to typed rows."""
    rows = df.select(F.from_json(F.col(column), schema).alias("doc")).select("doc.*")
    return fill_defaults(rows, schema, defaults or {})


def read_entities(df: DataFrame, column: str, entity: str) -> DataFrame:
    """JSON documents of a stored entity, by its name, to rows with its defaults."""
    return from_documents(df, column, *ENTITIES[entity])


def drop_private(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def canonical(column: Column, dtype: T.DataType) -> Column:
    """A nested value in the form it is stored in: sets sorted and distinct, maps by value, times UTC."""
    if isinstance(dtype, T.ArrayType):
        items = F.transform(column, lambda x: canonical(x, dtype.elementType))
        atomic = not isinstance(dtype.elementType, (T.MapType, T.ArrayType, T.StructType))
        return F.array_sort(F.array_distinct(items)) if atomic else items
    if isinstance(dtype, T.MapType):
        return F.transform_values(column, lambda _, v: canonical(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        fields = [canonical(column[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, (T.TimestampNTZType,)):
        return column.cast("timestamp")
    return column


def to_documents(df: DataFrame, column: str = "document") -> DataFrame:
    """Typed rows to JSON documents with private fields dropped and collections canonical."""
    public = drop_private(df)
    fields = [canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in public.schema.fields]
    return public.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(column))


def put_key(mapping: Column, key: Column, value: Column) -> Column:
    """Set one key of a map column, replacing its old value."""
    others = F.map_filter(mapping, lambda k, _: k != key)
    return F.coalesce(F.map_concat(others, F.create_map(key, value)), F.create_map(key, value))


def drop_key(mapping: Column, key: Column) -> Column:
    return F.map_filter(mapping, lambda k, _: k != key)


def explode_two_levels(df: DataFrame, column: str, outer: str, inner: str, value: str) -> DataFrame:
    """``{outer: {inner: value}}`` to long rows."""
    keep = [c for c in df.columns if c != column]
    first = df.select(*keep, F.explode(column).alias(outer, "_inner"))
    return first.select(*keep, outer, F.explode("_inner").alias(inner, value))


def overlay_maps(old: Column, new: Column) -> Column:
    """Two-level maps merged key by key, the new value winning."""
    def pick(_, before, after):
        return F.coalesce(after, before)

    def merge(_, before, after):
        return F.when(before.isNull(), after).when(after.isNull(), before).otherwise(
            F.map_zip_with(before, after, pick))

    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_zip_with(old, new, merge))


def nested_value(document: Column, path: str) -> Column:
    """A dotted path into a JSON document held as text."""
    return F.get_json_object(document, "$." + path)
