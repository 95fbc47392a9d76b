"""Row rules of sources: what a row must have to count, and which of several columns gives a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.shared import free_name


def sparse(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys and values, with null for zeros, empty texts, NaN and false."""
    kinds = dict(df.dtypes)

    def shown(c: str) -> Column:
        v = F.col(c)
        if kinds[c] == "string":
            return F.nullif(v, F.lit(""))
        if kinds[c] == "boolean":
            return F.when(v, v)
        return F.when((v != 0) & ~F.isnan(v.cast("double")), v)

    return df.select(*keys, *[shown(c).alias(c) for c in values])


def with_any(df: DataFrame, measures: list[str]) -> DataFrame:
    """Rows that have one of the measures."""
    return df.filter(F.greatest(*[F.col(m).isNotNull() for m in measures], F.lit(False)))


def first_accepted(candidates: list[tuple[Column, float]]) -> Column:
    """The first value that reaches its threshold."""
    return F.coalesce(*[F.when(v >= least, v) for v, least in candidates])


def renamed(df: DataFrame, old: str, new: str) -> DataFrame:
    """new, or old where new is missing; old goes (P24). A table without one of them is taken as if it held nulls."""
    have = [F.col(c) for c in (new, old) if c in df.columns]
    return df.withColumn(new, F.coalesce(*have)).drop(*({old} - {new})) if have else df


def by_version(version: Column, of: dict[str, Column], other: Column) -> Column:
    """The column of the form's version, else the other one."""
    out = F
    for name, value in of.items():
        out = out.when(version == name, value)
    return out.otherwise(other)


def relabelled(df: DataFrame, column: str, old: str, new: str, **overrides: Column) -> DataFrame:
    """Only the rows of one source, under another name and with other values in some columns."""
    return df.filter(F.col(column) == old).withColumns({column: F.lit(new), **overrides})


def without_headings(df: DataFrame, words: dict[str, str]) -> DataFrame:
    """Rows none of whose cells equals its heading, whatever the case."""
    same = [F.coalesce(F.lower(F.trim(c)) == word.lower(), F.lit(False)) for c, word in words.items()]
    return df.filter(~F.greatest(*same, F.lit(False)))


def positive(value: Column) -> Column:
    """Amounts above zero, else null."""
    return F.when(value > 0, value)


def readable(df: DataFrame, content: str, marks: list[str]) -> DataFrame:
    """Downloads whose content has none of the error marks; missing content goes too."""
    bad = [F.col(content).contains(m) for m in marks]
    return df.filter(F.col(content).isNotNull() & ~F.greatest(*bad, F.lit(False)))


def map_rows(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """One row for each entry of a map (M5)."""
    return df.select(*[c for c in df.columns if c != column], F.explode(column).alias(key, value))


def long_report(df: DataFrame, section: str) -> DataFrame:
    """(section, metric, value) for each column of one row of figures (K9)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns])
    return df.select(F.lit(section).alias("section"), F.explode(pairs).alias("p")).select("section", "p.metric", "p.value")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of each table."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


def compared(df: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """How series a differs from b: mean, variance and deviation of the differences, mean absolute per cent."""
    d = F.col(a) - F.col(b)
    share = F.when(F.col(b) != 0, F.abs(d) / F.abs(b) * 100)
    return df.filter(d.isNotNull()).groupBy(*keys).agg(F.avg(d).alias("meanDiff"), F.var_pop(d).alias("variance"), F.stddev_pop(d).alias("sd"), F.avg(share).alias("meanAbsPct"))


def first_of_each(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each key, in an order that must be total: a cap on what is taken from each list."""
    rank, at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)), free_name(df, "rank")
    return df.withColumn(at, rank).filter(F.col(at) <= n).drop(at)


def labelled_by_membership(df: DataFrame, key: str, sets: dict[str, DataFrame], label: str) -> DataFrame:
    """df with the label of the first of the sets (label: table with the key) that has its key, else null."""
    marks = [free_name(df, f"in_{i}") for i in range(len(sets))]
    for mark, keys in zip(marks, sets.values(), strict=True):
        df = df.join(keys.select(key).dropna().distinct().withColumn(mark, F.lit(True)), key, "left")
    return df.withColumn(label, F.coalesce(*[F.when(F.col(m), F.lit(name)) for m, name in zip(marks, sets, strict=True)])).drop(*marks)


def trimmed(df: DataFrame, *columns: str) -> DataFrame:
    """df with white space taken off both ends of columns."""
    return df.withColumns({c: F.regexp_replace(c, r"^\s+|\s+$", "") for c in columns})
