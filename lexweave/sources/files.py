"""Files in and out: case JSON, lookups, documents in DOCX, text, CSV, id lists, and the sinks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a raw case record, all text.
CASE_FIELDS = (
    "sharepointid rank itemid docname doctype application appno conclusion importance originatingbody typedescription kpdate kpdateAsText "
    "documentcollectionid documentcollectionid2 languageisocode extractedappno isplaceholder doctypebranch respondent respondentOrderEng "
    "ecli article applicability decisiondate externalsources introductiondate issue judgementdate kpthesaurus meetingnumber representedby "
    "separateopinion scl"
).split()
CASE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in CASE_FIELDS])
_PAYLOAD = T.StructType(
    [
        T.StructField("results", T.ArrayType(T.StructType([T.StructField("columns", CASE_SCHEMA)]))),
        T.StructField("_broken", T.StringType()),
    ]
)
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def read_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records of every JSON file of a folder; files that can't be read give none. ``Rank`` is read as ``rank``."""
    files = (
        spark.read.schema(_PAYLOAD)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
        .json(f"{folder}/*.json")
    )
    return files.select(F.explode("results").alias("r")).select("r.columns.*")


def broken_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the files that can't be read, to be reported."""
    texts = spark.read.text(f"{folder}/*.json", wholetext=True).withColumn("path", F.input_file_name())
    return texts.where(F.expr("try_parse_json(value) is null")).select("path")


def read_judges(spark: SparkSession, path: str) -> DataFrame:
    """The nested map of judges as one text value, for lookups.judges."""
    return spark.read.text(path, wholetext=True)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def read_csv(spark: SparkSession, path: str, columns: list[int]) -> DataFrame:
    """Columns of a CSV file by their place."""
    df = spark.read.csv(path, header=True)
    return df.select(*[F.col(f"`{df.columns[i]}`") for i in columns])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(itemid): one id per line; ids of a file aren't validated."""
    return spark.read.text(path).select(F.trim("value").alias("itemid")).where("itemid <> ''")


def _paragraph(p) -> str:
    """All text of a paragraph, also inside smart tags and other wrappers."""
    return "".join(t.text or "" for t in p.iter(f"{_W}t"))


def docx_blocks(data: bytes) -> list[tuple[int, str, str | None, str | None]]:
    """(pos, kind, style, text) of a document's paragraphs and tables in their order; a table's text is its rows by tab and newline."""
    out: list[tuple[int, str, str | None, str | None]] = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    if body is None:
        return out
    style: str | None = None
    work = list(body)[::-1]
    while work:
        block = work.pop()
        if block.tag == f"{_W}p":
            named = block.find(f"{_W}pPr/{_W}pStyle")
            style = named.get(f"{_W}val") if named is not None else "Normal"
            text = _paragraph(block)
            if text.strip():
                out.append((len(out), "paragraph", style, text))
        elif block.tag == f"{_W}tbl":
            rows = [
                "\t".join("\n".join(_paragraph(p) for p in c.iter(f"{_W}p")).replace("\n", " ").replace("\t", " ").strip() for c in r.findall(f"{_W}tc"))
                for r in block.iter(f"{_W}tr")
            ]
            out.append((len(out), "table", style, "\n".join(rows)))  # its level is that of the paragraph before it
        else:
            work.extend(list(block)[::-1])
    return out


def _docx(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, content in zip(batch["path"], batch["content"]):
            try:
                rows.extend((path, *b) for b in docx_blocks(content))
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                rows.append((path, -1, "broken", None, None))
        yield pd.DataFrame(rows, columns=["path", "pos", "kind", "style", "text"])


def read_docx(spark: SparkSession, folder: str) -> DataFrame:
    """(path, pos, kind, style, text): the blocks of every DOCX file; a broken file is one row of kind ``broken``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(folder).select("path", "content")
    return files.mapInPandas(_docx, "path string, pos int, kind string, style string, text string")


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, one folder per value of ``by``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_lines(df: DataFrame, column: str, path: str, order: str) -> None:
    """One text line per row in the order of a key: range-partitioned, so files follow one another."""
    df.repartitionByRange(order).sortWithinPartitions(order).select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """A set of tables as parquet, one folder each."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
