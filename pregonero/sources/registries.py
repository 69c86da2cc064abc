"""Registries of auctioneers as texts: records in lines and in blocks, unions of registries with their outcome, caches of
pages, and embedded JSON."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pregonero.functions.text import fold
from pregonero.session import ship_package

# Lines that are headings and no names.
HEADINGS = ["a a z", "leiloeiros", "matricula", "nome", "contato", "endereco"]
NUMBER_LINE = r"(?i)^matr[ií]cula\s*[:\-]\s*(\S+)"
NAME_LINE = r"(?i)^nome\s*:\s*(.+)$"
ONLY_DATE = r"^\d{2}/\d{2}/\d{4}$"
BLOCK = r"([A-ZÇÃÁÉÍÓÚÂÊÔÀ][A-ZÇÃÁÉÍÓÚÂÊÔÀ\s.\-']+?)\s*\(Matr[ií]cula:\s*([\w/.\-]+)(?:\s+de\s+\d{2}/\d{2}/\d{4})?\)(?:[^A-Za-z]*Situa[çc][ãa]o\s*:\s*([A-Z]+))?"


def _lines(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, no, line): the lines of each text that aren't blank, numbered from 0."""
    lines = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select(id_col, F.posexplode(lines).alias("no", "line"))


def _is_name(line: Column) -> Column:
    return (F.size(F.split(F.trim(line), r"\s+")) >= 2) & ~F.trim(fold(line)).isin(HEADINGS)


def names_before(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """SRC9: (id, name, registration): the line before one with a registration is the name, without a remark in brackets at
    its end; headings and single words are no names."""
    by_text = Window.partitionBy(id_col).orderBy("no")
    got = _lines(rows, id_col, text).withColumn("before", F.lag("line").over(by_text)).where(F.col("line").rlike(NUMBER_LINE) & _is_name(F.col("before")))
    return got.select(id_col, F.regexp_replace("before", r"\s*\([^)]*\)\s*$", "").alias("name"), F.regexp_extract("line", NUMBER_LINE, 1).alias("registration"))


def names_after(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """SRC15: (id, name, registration): the line after one with a registration (past a line that is only a date) is the name,
    or that after `Nome:` within the next four lines."""
    by_text = Window.partitionBy(id_col).orderBy("no")
    step = _lines(rows, id_col, text).withColumns({f"l{i}": F.lead("line", i).over(by_text) for i in range(1, 5)}).where(F.col("line").rlike(NUMBER_LINE))
    labelled = F.coalesce(*[F.nullif(F.regexp_extract(F.col(f"l{i}"), NAME_LINE, 1), F.lit("")) for i in range(1, 5)])
    next_line = F.when(F.col("l1").rlike(ONLY_DATE), F.col("l2")).otherwise(F.col("l1"))
    name = F.coalesce(labelled, F.when(_is_name(next_line), next_line))
    return step.select(id_col, F.trim(name).alias("name"), F.regexp_extract("line", NUMBER_LINE, 1).alias("registration")).where("name is not null")


def names_in_blocks(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """SRC16: distinct (id, name, registration, status) of all `NAME (Matrícula: N [de date]) [Situação: S]` of a text taken
    as one line; a missing status is regular, single words are no names."""
    one = F.regexp_replace(F.col(text), r"\s+", " ")
    g = lambda i: F.regexp_extract_all(one, F.lit(BLOCK), i)
    found = rows.select(id_col, F.explode(F.arrays_zip(g(1).alias("n"), g(2).alias("m"), g(3).alias("s"))).alias("x"))
    name = F.regexp_replace("x.n", r"^[\s\-–]+|[\s\-–]+$", "")
    got = found.select(id_col, name.alias("name"), F.trim("x.m").alias("registration"), F.lower(F.coalesce(F.nullif("x.s", F.lit("")), F.lit("regular"))).alias("status"))
    return got.where(F.size(F.split("name", r"\s+")) >= 2).distinct()


def union_registries(spark: SparkSession, readers: dict[str, Callable[[SparkSession], DataFrame]]) -> tuple[DataFrame | None, DataFrame]:
    """SRC8: (rows of all registries that could be read, with their name; (registry, outcome, rows)). A reader that isn't
    written yet raises NotImplementedError and is a stub; another error is a failure, and the others go on."""
    rows, outcomes = None, []
    for name, reader in readers.items():
        try:
            got = reader(spark).withColumn("registry", F.lit(name))
            outcomes.append((name, "success", got.count()))
            rows = got if rows is None else rows.unionByName(got, allowMissingColumns=True)
        except NotImplementedError:
            outcomes.append((name, "stub", 0))
        except Exception:  # noqa: BLE001
            outcomes.append((name, "failure", 0))
    return rows, spark.createDataFrame(outcomes, "registry string, outcome string, rows long")


def collected_pages(pages: DataFrame, data: str, total: str) -> DataFrame:
    """SRC6: (total, collected, complete): whether the pages of an interface hold as many records as they say."""
    return pages.agg(F.max(total).alias("total"), F.coalesce(F.sum(F.size(data)), F.lit(0)).cast("long").alias("collected")).select("total", "collected", (F.col("total") == F.col("collected")).alias("complete"))


def cached_html(urls: DataFrame, cache: DataFrame, prefer: str) -> DataFrame:
    """SRC5: (url, kind, html) from a cache of (key, kind, html), key the sha1 of the address: the preferred kind (static or
    dynamic), else the other, else null."""
    other = "dynamic" if prefer == "static" else "static"
    pick = lambda k: F.max_by("html", F.when((F.col("kind") == k) & F.col("html").isNotNull(), F.length("html")))
    by_key = cache.groupBy("key").agg(pick(prefer).alias("a"), pick(other).alias("b"))
    got = urls.withColumn("key", F.sha1("url")).join(by_key, "key", "left")
    return got.select("url", F.when(F.col("a").isNotNull(), prefer).when(F.col("b").isNotNull(), other).alias("kind"), F.coalesce("a", "b").alias("html"))


def read_html_files(spark: SparkSession, glob: str) -> DataFrame:
    """SRC5: (key, kind, html) of files named key.kind.html."""
    files = spark.read.text(glob, wholetext=True).select(F.col("value").alias("html"), F.element_at(F.split("_metadata.file_name", r"\."), 1).alias("key"), F.element_at(F.split("_metadata.file_name", r"\."), 2).alias("kind"))
    return files.select("key", "kind", "html")


def balanced_object(text: str | None, opening: str) -> str | None:
    """The JSON object after the first `opening` up to its own closing brace; braces in strings don't count."""
    at = -1 if text is None else text.find(opening)
    start = -1 if at < 0 else text.find("{", at + len(opening))
    if start < 0:
        return None
    depth, quoted, skip = 0, False, False
    for i in range(start, len(text)):
        c = text[i]
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if not depth:
                return text[start : i + 1]
    return None


def embedded_json(pages: DataFrame, html: str, opening: str, out: str) -> DataFrame:
    """SRC14: pages with the balanced object after `opening` as JSON text, null without one. Over Arrow batches."""
    ship_package(pages.sparkSession)

    @F.pandas_udf("string")
    def cut_out(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: balanced_object(x if isinstance(x, str) else None, opening))

    return pages.withColumn(out, cut_out(F.col(html)))


def linked_data(pages: DataFrame, html: str, kind: str, schema: str) -> DataFrame:
    """SRC14: the pages' other columns and x, the linked-data objects of a kind."""
    all_ = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.explode(all_).alias("j")).select(*rest, F.from_json("j", f"`@type` string, {schema}").alias("x")).where(F.col("x.`@type`") == kind)
