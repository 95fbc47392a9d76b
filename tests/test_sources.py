"""Readers and parsers on small files."""

import json

from pyspark.sql import functions as F

from tidemark.sources import files, html

TABLE = "<table><tr><th>Ex Date*<th>Dividend</tr><tr><td>1/2<td>0.5</tr><tr><td>1/3</td><td>0.6</td></tr></table>"


def test_json_and_csv(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1, "v": "x"}, {"k": 2}]))
    assert files.json_rows(spark, str(tmp_path / "a.json"), "k int, v string").count() == 2
    (tmp_path / "b.csv").write_text('k,v\n1,"a ""b"",\nc"\n')
    assert files.csv_rows(spark, str(tmp_path / "b.csv"), "k int, v string").first()["v"] == 'a "b",\nc'
    (tmp_path / "c.csv").write_text("p\n" * 5 + "1,2\n3,4\nend\n5,6\n")
    assert [tuple(r) for r in files.csv_after_preamble(spark, str(tmp_path / "c.csv"), "a int, b int").collect()] == [(1, 2), (3, 4)]
    (tmp_path / "l.txt").write_text(" a \n\n b\n")
    assert {r["line"] for r in files.line_list(spark, str(tmp_path / "l.txt")).collect()} == {"a", "b"}


def test_xml_json_shapes(spark):
    df = spark.createDataFrame([("<r><a>1</a></r>", 'cb([{"x":1}]);', '{"x": 1}'), ("<r><a>1</a><a>2</a></r>", "cb([])", '[{"x": 1}, {"x": 2}]')], "xml string, p string, j string")
    got = df.select(F.size(files.xml_column(F.col("xml"), "a array<int>")["a"]).alias("n"), files.unwrapped(F.col("p")).alias("u"), F.size(files.array_of(F.col("j"), "struct<x:int>")).alias("m")).collect()
    assert [tuple(r) for r in got] == [(1, '[{"x":1}]', 1), (2, "[]", 2)]
    sheet = "<Row><Cell><Data t='s'>a</Data></Cell><Cell><Data>b</Data></Cell></Row>"
    assert spark.range(1).select(files.workbook_rows(F.lit(sheet)).alias("r")).first()["r"] == [["a", "b"]]


def test_tables(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>no</td></tr></table>" + TABLE), (2, None)], "id int, html string")
    cells = html.cells(pages, "id", "html")
    found = html.records(html.tables_with(cells, "id", "dividend"), "id").collect()
    assert sorted(r["record"]["dividend"] for r in found) == ["0.5", "0.6"] and found[0]["record"].keys() == {"exdate", "dividend"}
    assert html.grid_value(cells, "id", "1/3").first()["value"] == "0.6"
    assert html.cell_after(cells, "id", "1/2").first()["value"] == "0.5"
    links = html.attributes(spark.createDataFrame([(1, "<a href='x'>1</a><a>2</a><a href=y>3</a>")], "id int, html string"), "id", "html", "a", "href")
    assert [(r["pos"], r["value"]) for r in links.collect()] == [(0, "x"), (1, "y")]
    assert [r["text"] for r in html.elements(spark.createDataFrame([(1, "<ul><li>a<li>b &amp; c</ul>")], "id int, html string"), "id", "html", "li").collect()] == ["a", "b & c"]


def test_guards_and_writers(spark, tmp_path):
    df = spark.range(25).withColumn("tags", F.array(F.lit("a"), F.lit("b")))
    assert files.at_least(df, 25).count() == 25
    try:
        files.at_least(df, 26).collect()
    except Exception as e:
        assert "fewer than 26 rows" in str(e)
    else:
        raise AssertionError
    assert {r["batch"]: r["count"] for r in files.batches_of(df.drop("tags"), "id").groupBy("batch").count().collect()} == {0: 10, 1: 10, 2: 5}
    files.write_csv(df, f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).first()["tags"] == "a;b"
    files.write_by(df.select("id", (F.col("id") % 2).alias("k")), f"{tmp_path}/by", "k")
    files.write_by(spark.createDataFrame([(99, 1)], "id long, k long"), f"{tmp_path}/by", "k")
    assert spark.read.parquet(f"{tmp_path}/by").filter("k = 0").count() == 13 and spark.read.parquet(f"{tmp_path}/by").filter("k = 1").count() == 1


def test_json_and_runs(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    files.write_json(rows, str(tmp_path / "j"))
    assert sorted(json.loads(x)["k"] for f in (tmp_path / "j").glob("part-*") for x in f.read_text().splitlines()) == [1, 2]
    for run, want in (("001", {"latest": "001"}), ("002", {"latest": "002", "previous": "001"}), ("002", {"latest": "002", "previous": "001"})):
        assert {r["name"]: r["run"] for r in files.write_run(rows, str(tmp_path / "r"), run).collect()} == want
    assert spark.read.parquet(str(tmp_path / "r" / "runs")).count() == 4


ODD_TABLES = [
    "<table><td>Other<tr><th>Divi* dend<th>b</tr><tr><td>1</td><td>&amp;2<b> x</b></td><td>no head</td></tr>\n<TR><td>3</TD></table>",
    '<table><tr><td>none</table><p>x</p><table a="b"><tr><th class="c d">dividend</th><th>n</th></tr><tr><td>a &lt;b</td><td/>z</tr><table><tr><td>in</td></tr></table></table>',
    "<table><tr><th>dividend<th>script</tr><tr><td><script>'<td>no</td>'</script>9<!-- <td> --><td>a < b</tr></table>",
    "<table><tr><th>dividend</tr><tr></tr><tr><td>1 &am<i>p;</i></tr><tr><td>2",
    "no table", "", None, "<td>lost<table>",
]


def test_tables_within_pages_are_those_of_cells(spark):
    """Plain pages are split, others parsed; what a page's own rows give is what joins of cells give."""
    for page in ODD_TABLES:
        assert html._table_cells(page) == html._parsed(html._Tables(), page).cells
    df = spark.createDataFrame(list(enumerate(ODD_TABLES)), "id int, html string")
    cells, rows = html.cells(df, "id", "html"), html.table_rows(df, "id", "html")
    want = sorted((r["id"], sorted(r["record"].items())) for r in html.records(html.tables_with(cells, "id", "dividend"), "id").collect())
    got = sorted((r["id"], sorted(r["x"].items())) for r in rows.select("id", F.explode(html.row_records(F.col("rows"), "dividend")).alias("x")).collect())
    assert got == want and len(want) == 6
    value, after = html.row_value(F.col("rows"), "1").alias("v"), html.row_cell_after(F.col("rows"), "3").alias("a")
    assert {r["id"]: r["v"] for r in rows.select("id", value).collect() if r["v"] is not None} == {r["id"]: r["value"] for r in html.grid_value(cells, "id", "1").collect()}
    assert {r["id"]: r["a"] for r in rows.select("id", after).collect() if r["a"] is not None} == {r["id"]: r["value"] for r in html.cell_after(cells, "id", "3").collect() if r["value"] is not None}


def test_table_rows_are_not_shuffled(spark):
    df = spark.createDataFrame(list(enumerate(ODD_TABLES)), "id int, html string")
    plan = html.table_rows(df, "id", "html").select(html.row_records(F.col("rows"), "dividend"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
