"""Values inside nested columns: transforms and lookups at any depth that keep order and nesting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tidemark.shared import broadcast_if_small, cut_lineage, free_name


def changed(value: Column, kind: DataType, path: list[str], change: Callable[[Column], Column]) -> Column:
    """value with change() applied to what a path of field names leads to; arrays on the way, of any depth, are
    passed through element by element. Null arrays and structs stay null."""
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: changed(x, kind.elementType, path, change))
    if path:
        name, *rest = path
        return F.when(value.isNotNull(), value.withField(name, changed(value[name], _field(kind, name), rest, change)))
    return change(value)


def leaves(value: Column, kind: DataType, path: list[str]) -> Column:
    """All values that a path leads to, as one array in order; of null arrays and structs there are none."""
    if isinstance(kind, ArrayType):
        parts = F.transform(value, lambda x: leaves(x, kind.elementType, path))
        return F.when(value.isNotNull(), F.flatten(parts)).otherwise(F.array().cast(ArrayType(_leaf(kind, path))))
    if path:
        return leaves(value[path[0]], _field(kind, path[0]), path[1:])
    return F.array(value)


def _field(kind: DataType, name: str) -> DataType:
    if not isinstance(kind, StructType):
        raise ValueError(f"no field {name} in {kind.simpleString()}")
    return kind[name].dataType


def _leaf(kind: DataType, path: list[str]) -> DataType:
    while isinstance(kind, ArrayType) or path:
        kind, path = (kind.elementType, path) if isinstance(kind, ArrayType) else (_field(kind, path[0]), path[1:])
    return kind


def changed_at(df: DataFrame, changes: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """df with columns changed at dotted paths, such as previous.owners."""
    for dotted, change in changes.items():
        name, *path = dotted.split(".")
        df = df.withColumn(name, changed(F.col(name), df.schema[name].dataType, path, change))
    return df


def looked_up(df: DataFrame, paths: dict[str, str], lookup: DataFrame, name: str, value: str) -> DataFrame:
    """df with further columns: paths says from which dotted path each one comes. It has the values of lookup in
    place of the names that the path leads to, in the same order and nesting of arrays; unknown and null
    names give null, and of a name that lookup has twice the least value counts.

    Rows with the same names share them. Each distinct set of names is joined with lookup once, name by name, and
    comes back to its rows as a map of its own names, so a row's arrays are never taken apart.
    """
    names, found = free_name(df, "names"), free_name(df, "found")
    all_of = []
    for dotted in paths.values():
        top, *path = dotted.split(".")
        all_of.append(leaves(F.col(top), df.schema[top].dataType, path))
    kept = df.withColumn(names, F.array_sort(F.array_distinct(F.filter(F.concat(*all_of), lambda x: x.isNotNull()))))
    sets = cut_lineage(kept.select(F.col(names).alias("names")).distinct())
    known = lookup.filter(F.col(name).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(value).alias("value"))
    maps = sets.select("names", F.explode("names").alias("name")).join(broadcast_if_small(known), "name").groupBy("names").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("found"))
    both = kept.join(broadcast_if_small(cut_lineage(maps.withColumnsRenamed({"names": names, "found": found}))), names, "left")
    for into, dotted in paths.items():
        top, *path = dotted.split(".")
        ids = _only(F.col(top), df.schema[top].dataType, path, lambda x: F.try_element_at(F.col(found), x))
        both = both.withColumn(into, ids)
    return both.select(*[F.col(f"`{c}`") for c in df.columns], *paths)


def _only(value: Column, kind: DataType, path: list[str], change: Callable[[Column], Column]) -> Column:
    """What a path leads to, changed, in the arrays that it stands in and without the structs."""
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _only(x, kind.elementType, path, change))
    return _only(value[path[0]], _field(kind, path[0]), path[1:], change) if path else change(value)
