"""Sources and sinks: CSV, JSON lines, JSON folders, HTML, XML, nested parquet, text blocks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from pregonero.functions.text import fold
from pregonero.session import shared_dir, ship_package


def round_trip(rows: DataFrame, form: str) -> str:
    """Write rows to a new folder of the shared space in a form (csv with header, json, parquet) and give its path."""
    path = f"{shared_dir(rows.sparkSession)}/sink-{uuid.uuid4().hex}"
    writer = rows.write.option("header", True) if form == "csv" else rows.write
    writer.format(form).save(path)
    return path


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: all columns as strings."""
    return spark.read.option("header", True).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC2: JSON lines with the file they come from; blank lines are skipped."""
    return spark.read.schema(schema).json(path).withColumn("__source_file", F.col("_metadata.file_name"))


def read_json_folder(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """SRC4: one JSON document per file; a file that can't be read comes out with corrupt = true."""
    rows = spark.read.schema(f"{schema}, __bad string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").json(glob)
    return rows.withColumn("corrupt", F.col("__bad").isNotNull()).drop("__bad")


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    """SRC13: elements of a tag as rows."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def nested_as_json(rows: DataFrame) -> DataFrame:
    """SNK2: structs, arrays and maps as JSON text."""
    nested = (StructType, ArrayType, MapType)
    return rows.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in rows.schema])


def previous_line(rows: DataFrame, id_col: str, text: str, separator: str, pattern: str) -> DataFrame:
    """SRC9/15: (id, line_no, name, registration): a line that holds the pattern names the entry of the line before."""
    lines = rows.where(F.col(text).isNotNull()).select(id_col, F.posexplode(F.split(text, separator)).alias("line_no", "s"))
    before = F.lag("s").over(Window.partitionBy(id_col).orderBy("line_no"))
    got = lines.select(id_col, "line_no", F.trim(before).alias("name"), F.nullif(F.regexp_extract(fold(F.col("s")), pattern, 1), F.lit("")).alias("registration"))
    return got.where(F.col("registration").isNotNull() & F.col("name").isNotNull())


class _Text(HTMLParser):
    SKIP = {"script", "style", "noscript", "template"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.SKIP

    def handle_endtag(self, tag):
        self.depth -= tag in self.SKIP and self.depth > 0

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def strip_html(html: str | None) -> str | None:
    """PRJ18: visible text with single spaces; null stays null."""
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    return re.sub(r"\s+", " ", " ".join(parser.parts)).strip()


def html_text(rows: DataFrame, column: str, out: str = "text") -> DataFrame:
    """PRJ18 over Arrow batches."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def visible(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: strip_html(None if x is None or x is pd.NA else x))

    return rows.withColumn(out, visible(F.col(column)))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared space."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def round_trip_xml(rows: DataFrame, row_tag: str) -> str:
    """Write rows as XML elements and give the path."""
    path = new_folder(rows.sparkSession, "xml")
    rows.write.format("xml").option("rowTag", row_tag).option("rootTag", "all").save(path)
    return path


def flatten_pages(pages: DataFrame, data: str) -> DataFrame:
    """SRC6: the records of the pages of an interface."""
    return pages.select(F.explode(data).alias("x")).select("x.*")


def inline_json(pages: DataFrame, html: str, pattern: str, schema: str) -> DataFrame:
    """SRC14: a JSON object within a script as columns; pages without it are left out, broken ones give nulls."""
    found = F.nullif(F.regexp_extract(F.col(html), pattern, 1), F.lit(""))
    return pages.select(found.alias("j")).where("j is not null").select(F.from_json("j", schema).alias("x")).select("x.*")
