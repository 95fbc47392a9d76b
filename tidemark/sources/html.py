"""Rows out of HTML columns, parsed in Arrow batches by the standard library's parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import header_key


class _Elements(HTMLParser):
    """Texts and attributes of the elements of one tag, in order of their start."""

    def __init__(self, tag: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.open, self.found = tag, [], []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == self.tag:
            if tag in ("li", "td", "th", "p"):  # their end tags may be left out
                self.open = []
            self.found.append([[], dict(attrs)])
            self.open.append(self.found[-1])

    def handle_endtag(self, tag: str) -> None:
        if tag == self.tag and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        for x in self.open:
            x[0].append(data)


class _Tables(HTMLParser):
    """Cells (table, row, column, heading or not, text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells, self.table, self.row, self.column, self.cell = [], -1, -1, -1, None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.table, self.row = self.table + 1, -1
        elif tag == "tr":
            self.row, self.column = self.row + 1, -1
        elif tag in ("td", "th") and self.table >= 0:
            self.column += 1
            self.cell = [self.table, max(self.row, 0), self.column, tag == "th", []]
            self.cells.append(self.cell)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell:
            self.cell[4].append(data)


#: Tags without oddities; a page of these and of text alone needs no parser. Contents of RAW elements are no markup.
_PLAIN_TAG = re.compile(r'<(/[A-Za-z][A-Za-z0-9]*(?=\s*>)|[A-Za-z][A-Za-z0-9]*)(?:\s+[A-Za-z_:][A-Za-z0-9_:.-]*="[^"<>]*")*\s*>')
_RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext".split())


def _table_cells(page: str | None) -> list[list]:
    """What _Tables finds, by one split of the page where its tags are plain, which takes a fraction of the time."""
    parts = _PLAIN_TAG.split(page or "")
    tags = list(map(str.lower, parts[1::2]))
    if (page or "").count("<") != len(tags) or not _RAW.isdisjoint(tags):
        return _parsed(_Tables(), page).cells
    cells, table, row, column, cell = [], -1, -1, -1, None
    for tag, data in zip(tags, parts[2::2], strict=True):
        if tag in ("td", "th"):
            if table >= 0:
                column += 1
                cell = [table, max(row, 0), column, tag == "th", []]
                cells.append(cell)
        elif tag in ("/td", "/th", "/tr", "/table"):
            cell = None
        elif tag == "tr":
            row, column = row + 1, -1
        elif tag == "table":
            table, row = table + 1, -1
        if cell and data:
            cell[4].append(unescape(data) if "&" in data else data)
    return cells


def _parsed(parser: HTMLParser, html: str | None):
    parser.feed(html or "")
    parser.close()
    return parser


def _rows(df: DataFrame, key: str, html: str, names: str, rows) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(k, *row) for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for row in rows(page)]
            kinds = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
            types = [batch.schema.field(0).type, *(kinds[x.split()[1]] for x in names.split(", "))]
            columns = list(zip(*out, strict=True)) if out else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [key, *(x.split()[0] for x in names.split(", "))])

    return df.select(key, html).mapInArrow(run, f"{key} {kind}, {names}")


def elements(df: DataFrame, key: str, html: str, tag: str) -> DataFrame:
    """(key, pos, text) of each element of a tag."""
    return _rows(df, key, html, "pos int, text string", lambda page: [(i, "".join(x).strip()) for i, (x, _) in enumerate(_parsed(_Elements(tag), page).found)])


def attributes(df: DataFrame, key: str, html: str, tag: str, name: str) -> DataFrame:
    """(key, pos, value) of an attribute of each element that has it."""
    return _rows(df, key, html, "pos int, value string", lambda page: list(enumerate(a[name] for _, a in _parsed(_Elements(tag), page).found if name in a)))


ROWS = "array<struct<table:int,row:int,cells:array<struct<col:int,heading:boolean,text:string>>>>"


def table_rows(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, rows): for each page the rows of its tables in page order, each with its cells. Pages stay rows, so that
    what is looked up in a page needs no shuffle."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, tables, numbers, row_ends, cols, headings, texts = [0], [], [], [0], [], [], []
            for page in batch.column(1).to_pylist():
                at = None
                for table, row, col, heading, text in _table_cells(page):
                    if at != (table, row):
                        at = (table, row)
                        tables.append(table)
                        numbers.append(row)
                        row_ends.append(row_ends[-1])
                    row_ends[-1] += 1
                    cols.append(col)
                    headings.append(heading)
                    texts.append(" ".join("".join(text).split()))
                ends.append(len(tables))
            cells = pa.StructArray.from_arrays([pa.array(cols, pa.int32()), pa.array(headings, pa.bool_()), pa.array(texts, pa.string())], ["col", "heading", "text"])
            rows = pa.StructArray.from_arrays([pa.array(tables, pa.int32()), pa.array(numbers, pa.int32()), pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), cells)], ["table", "row", "cells"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)], [key, "rows"])

    return df.select(key, html).mapInArrow(run, f"{key} {kind}, rows {ROWS}")


def _once(value: Column, use) -> Column:
    """use(value), with value made once for a page: it is the one element of an array that is mapped over."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def row_records(rows: Column, word: str) -> Column:
    """records(tables_with()) within a page: the records of the first table whose first row holds the word, in order."""
    name = lambda c: header_key(c["text"])
    holds = lambda r: (r["row"] == 0) & F.exists(r["cells"], lambda c: name(c).contains(word))
    first = lambda r: F.get(F.filter(r, holds), F.lit(0))["table"]
    own = _once(F.struct(rows.alias("r"), first(rows).alias("t")), lambda x: F.filter(x["r"], lambda r: r["table"] == x["t"]))
    heads = lambda own: F.transform(F.flatten(F.transform(F.filter(own, lambda r: r["row"] == 0), lambda r: r["cells"])), lambda c: F.struct(c["col"].alias("col"), name(c).alias("name")))
    # names of each column; one may have several where cells stand before the first row
    columns = lambda h: F.transform(F.sequence(F.lit(0), F.array_max(F.transform(h, lambda c: c["col"]))), lambda i: F.transform(F.filter(h, lambda c: c["col"] == i), lambda c: c["name"]))
    cell = lambda c, n: F.transform(F.coalesce(F.get(n, c["col"]), F.array().cast("array<string>")), lambda x: F.struct(x.alias("name"), c["text"].alias("text")))
    entries = lambda own, n: F.transform(F.filter(own, lambda r: r["row"] > 0), lambda r: F.flatten(F.transform(r["cells"], lambda c: cell(c, n))))
    found = _once(own, lambda o: _once(_once(heads(o), columns), lambda n: entries(o, n)))
    return F.transform(F.filter(found, lambda e: F.size(e) > 0), lambda e: F.map_from_entries(F.array_sort(e)))


def row_value(rows: Column, label: str) -> Column:
    """grid_value() within a page."""
    row = F.get(F.filter(rows, lambda r: F.get(r["cells"], F.lit(0))["text"].contains(label)), F.lit(0))
    return F.element_at(row["cells"], -1)["text"]


def row_cell_after(rows: Column, label: str, ahead: int = 1) -> Column:
    """cell_after() within a page."""
    texts = F.flatten(F.transform(rows, lambda r: F.transform(r["cells"], lambda c: c["text"])))
    at = lambda t: F.array_position(t, label)
    return _once(texts, lambda t: F.when(at(t) > 0, F.get(t, (at(t) - 1 + ahead).cast("int"))))


def cells(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table, row, col, heading, text) of each table cell."""
    rows = table_rows(df, key, html).select(key, F.explode("rows").alias("r")).select(key, F.col("r.table").alias("table"), F.col("r.row").alias("row"), F.explode("r.cells").alias("c"))
    return rows.select(key, "table", "row", "c.*")


def records(table_cells: DataFrame, key: str) -> DataFrame:
    """(key, table, row, record): a map from the first row's cells, as header keys, to each row's."""
    heads = table_cells.filter("row = 0").select(key, "table", "col", header_key(F.col("text")).alias("name"))
    rows = table_cells.filter("row > 0").join(heads, [key, "table", "col"])
    return rows.groupBy(key, "table", "row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "text")))).alias("record"))


def tables_with(table_cells: DataFrame, key: str, word: str) -> DataFrame:
    """The cells of each page's first table whose first row holds the word."""
    first = table_cells.filter((F.col("row") == 0) & header_key(F.col("text")).contains(word)).groupBy(key).agg(F.min("table").alias("table"))
    return table_cells.join(first, [key, "table"], "left_semi")


def grid_value(table_cells: DataFrame, key: str, label: str) -> DataFrame:
    """(key, value): the last cell of the first row whose first cell contains the label."""
    rows = table_cells.groupBy(key, "table", "row").agg(F.min_by("text", "col").alias("head"), F.max_by("text", "col").alias("value"))
    return rows.filter(F.col("head").contains(label)).groupBy(key).agg(F.min_by("value", F.struct("table", "row")).alias("value"))


def cell_after(table_cells: DataFrame, key: str, label: str, ahead: int = 1) -> DataFrame:
    """(key, value): the cell so many places after the first one that equals the label, in page order."""
    flat = F.array_sort(F.collect_list(F.struct("table", "row", "col", "text")))
    texts = table_cells.groupBy(key).agg(flat.alias("c")).select(key, F.col("c.text").alias("t"))
    at = F.array_position("t", label)
    return texts.select(key, F.when(at > 0, F.get("t", (at - 1 + ahead).cast("int"))).alias("value"))


def between(text: Column, start: str, end: str) -> Column:
    """What stands between a marker and the last place of another."""
    after = F.regexp_extract(text, f"(?s){start}(.*)", 1)
    return F.regexp_extract(after, f"(?s)^(.*){end}", 1)
