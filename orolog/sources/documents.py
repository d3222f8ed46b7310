"""Documents from files: binary PDFs to text, and texts as they are."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolog.functions import exprs as X


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modificationTime, length, content`` of one file, whatever it is called, or of the PDFs in a folder and below it."""
    reader = spark.read.format("binaryFile")
    if not is_folder(spark, path):
        return reader.load(path)
    return reader.option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def any_file(spark: SparkSession, path: str, glob: str) -> bool:
    """Whether a folder, or one below it, has a file of such a name."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path")
    return not found.isEmpty()


def text_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """``doc_id, text`` of whole text files; doc_id is the path."""
    read = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True)
    return read.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def pdf_texts(files: DataFrame) -> DataFrame:
    """``doc_id, text, error`` of binary PDFs; the only step that runs Python on the executors.

    A file that can't be read has a null text and the reason as its error.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from orolog.sources.pdf import PdfError, text_of

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows.append((path, text_of(bytes(content)), None))
                except PdfError as e:
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "text", "error"])

    return files.select("path", "content").mapInPandas(read, "doc_id string, text string, error string")


def stem(path) -> object:
    """File name of a path without its extension, as a column."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=[^.])\.[^.]*$", "")


def safe_stem(path) -> object:
    return X.safe_name(stem(path))
