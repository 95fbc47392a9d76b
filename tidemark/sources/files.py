"""Readers and writers of the file layouts that the jobs exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.shared import free_name


def json_rows(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """Arrays of objects, one or more files."""
    return spark.read.schema(schema).json(paths, multiLine=True)


def csv_rows(spark: SparkSession, paths: str | list[str], schema: StructType | str, header: bool = True, quoted: bool = True) -> DataFrame:
    """Quoted fields may hold separators, line ends and doubled quotes; unquoted ones are split as they are."""
    quotes = {"quote": '"', "escape": '"', "multiLine": True} if quoted else {"quote": ""}
    return spark.read.schema(schema).csv(paths, header=header, **quotes)


def csv_after_preamble(spark: SparkSession, path: str, schema: str, skip: int = 5) -> DataFrame:
    """Rows of each file after its first lines, up to the first short one. The lines of one file are
    ordered within the file's row."""
    files = spark.read.text(path, wholetext=True)
    fields = len(schema.split(","))
    lines = F.slice(F.split("value", "\r?\n"), skip + 1, 1_000_000_000)
    parsed = F.transform(lines, lambda x: F.split(x, ","))
    end = F.array_position(F.transform(parsed, lambda x: F.size(x) < fields), True)
    whole = F.when(end > 0, F.slice(parsed, 1, (end - 1).cast("int"))).otherwise(parsed)
    rows = files.select(F.explode(whole).alias("c"))
    typed = [x.split() for x in schema.split(",")]
    return rows.select(*[F.get("c", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(typed)])


def line_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")


def csv_named(spark: SparkSession, paths: str | list[str], names: dict[str, str], fields: int) -> DataFrame:
    """Columns of a CSV by place, under names of one's own: names says for each wanted name, in the order wanted, the
    heading it has in the file; the first line has the headings, and a heading that is missing gives nulls.
    Texts, as they are; rows of fewer fields end in nulls."""
    rows = spark.read.option("header", False).schema(", ".join(f"c{i} string" for i in range(fields))).csv(paths, quote='"', escape='"')
    cells = [F.trim(F.col(f"c{i}")) for i in range(fields)]
    heading = rows.withColumn("file", F.input_file_name()).filter(F.greatest(*[F.coalesce(c.isin(*names.values()), F.lit(False)) for c in cells], F.lit(False)))
    places = heading.groupBy("file").agg(F.first(F.array(*cells)).alias("heads"))  # a line for each file
    of = lambda head: F.get("cells", F.array_position("heads", head).cast("int") - 1)
    both = rows.select(F.input_file_name().alias("file"), F.array(*cells).alias("cells")).join(places, "file")
    return both.filter(F.col("cells") != F.col("heads")).select(*[F.when(F.array_position("heads", head) > 0, of(head)).alias(name) for name, head in names.items()])


def xml_column(text: Column, schema: str) -> Column:
    """A struct of an XML text; null fields where it is malformed. Array fields take single elements too."""
    return F.from_xml(text, schema)


def xml_rows(spark: SparkSession, paths: str | list[str], row_tag: str, schema: str) -> DataFrame:
    """A row for each element of a tag, wherever it stands in files of any length, with `malformed`: its text where
    it doesn't parse or doesn't fit the schema, else null. Of Spark's two parsers, only the one that takes elements one by one
    goes on after a malformed one; the session is set to it."""
    spark.conf.set("spark.sql.legacy.useLegacyXMLParser", "true")
    return spark.read.format("xml").options(rowTag=row_tag, mode="PERMISSIVE", columnNameOfCorruptRecord="malformed").schema(f"{schema}, malformed string").load(paths)


def validated_xml(df: DataFrame, text: str, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """df with `parsed`, a struct of an XML text, and `fault`: null, or why the text does not count: empty,
    malformed (or a value that isn't of its type), or missing <the first required field that is null>.
    Rows with faults stay, with what could be read."""
    parsed = F.from_xml(text, f"{schema}, malformed string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"})
    got = df.withColumn("parsed", parsed)
    p = F.col("parsed")
    blank = F.coalesce(F.trim(F.col(text)) == "", F.lit(True))
    missing = F.coalesce(*[F.when(p[c].isNull(), F.lit(f"missing {c}")) for c in required], F.lit(None).cast("string"))
    fault = F.when(blank, "empty").when(p.isNull() | p["malformed"].isNotNull(), "malformed").otherwise(missing)
    return got.withColumn("fault", fault).withColumn("parsed", F.when(p.isNotNull(), p.dropFields("malformed")))


def validation_report(validated: DataFrame, *keys: str) -> DataFrame:
    """For each key and fault (null: none), how many rows."""
    return validated.groupBy(*keys, "fault").agg(F.count("*").alias("rows"))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """df with a constant as its first column, as a date that only the file's place tells."""
    return df.select(F.lit(value).alias(name), *[F.col(f"`{c}`") for c in df.columns if c != name])


def workbook_rows(text: Column) -> Column:
    """Rows of cells of a workbook kept as XML."""
    rows = F.regexp_extract_all(text, F.lit(r"(?s)<(?:ss:)?Row[^>]*>(.*?)</(?:ss:)?Row>"), F.lit(1))
    return F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?s)<(?:ss:)?Data[^>]*>(.*?)</(?:ss:)?Data>"), F.lit(1)))


def unwrapped(text: Column) -> Column:
    """The argument of a JSON callback."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s*[\w.$]+\(", ""), r"\);?\s*$", "")


def array_of(text: Column, element: str) -> Column:
    """An array from JSON that holds one element or an array of them."""
    return F.coalesce(F.when(text.startswith("["), F.from_json(text, f"array<{element}>")), F.array(F.from_json(text, element)))


def with_file_facts(df: DataFrame) -> DataFrame:
    """The file's name, and the date it starts with."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return df.withColumn("file", name).withColumn("filed", F.try_to_date(F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"))


def at_least(df: DataFrame, rows: int) -> DataFrame:
    """df, or a failure when it runs if it has fewer rows."""
    name = free_name(df, "enough")
    enough = df.agg(F.assert_true(F.count("*") >= rows, F.lit(f"fewer than {rows} rows")).isNull().alias(name))
    return df.join(F.broadcast(enough), F.col(name)).drop(name)


def with_seed(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """df and literal rows that the source lacks."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))


def batches_of(df: DataFrame, order: str, size: int = 10) -> DataFrame:
    """A batch number for each row of a list, in order, by a global rank; for lists of keys."""
    at, part, before = (free_name(df, x) for x in ("at", "part", "before"))
    ranked = df.orderBy(order).select("*", F.monotonically_increasing_id().alias(at))
    per = ranked.groupBy(F.shiftright(at, 33).alias(part)).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offset = per.select(part, F.coalesce(earlier, F.lit(0)).alias(before))
    both = ranked.withColumn(part, F.shiftright(at, 33)).join(F.broadcast(offset), part)
    rank = F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return both.withColumn("batch", F.floor(rank / size).cast("int")).drop(at, part, before)


def write_csv(df: DataFrame, path: str) -> None:
    """With a header, all fields quoted, arrays joined by semicolons."""
    flat = [F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def write_json(df: DataFrame, path: str) -> None:
    """One object a line; columns that are null are left out."""
    df.write.mode("overwrite").json(path)


def write_run(df: DataFrame, path: str, run: str) -> DataFrame:
    """Keeps the rows of a run under runs/run=<run>, and returns (name, run): the latest run and the one before it,
    by name, as of all runs kept. The pointers are written to <path>/pointers."""
    spark = df.sparkSession
    df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{path}/runs")
    schema = StructType(list(df.schema.fields)).add("run", "string")
    kept = spark.read.schema(schema).parquet(f"{path}/runs").select("run").distinct().orderBy(F.desc("run")).limit(2)
    rank = F.row_number().over(Window.orderBy(F.desc("run")))
    pointers = kept.select(F.when(rank == 1, "latest").otherwise("previous").alias("name"), "run")
    pointers.write.mode("overwrite").parquet(f"{path}/pointers")
    return spark.read.parquet(f"{path}/pointers")


def write_by(df: DataFrame, path: str, *keys: str) -> None:
    """A folder for each key (ticker, day, run); only the keys in df are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def without_keys(df: DataFrame, key: str, gone: list[str]) -> DataFrame:
    return df.filter(~F.col(key).isin(*gone))


def files_with(df: DataFrame, content: str, wanted: str) -> DataFrame:
    """Names of the files whose content holds an id."""
    return df.filter(F.col(content).contains(wanted)).select(F.input_file_name().alias("file")).distinct()
