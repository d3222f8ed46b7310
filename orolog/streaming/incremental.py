"""New documents as they arrive in a folder: Structured Streaming in place of a list of ids that are done.

The checkpoint remembers which files were read; each micro-batch is parsed like any batch and appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orolog.operators import timesheet


def incoming_texts(spark: SparkSession, folder: str, glob: str = "*.txt", files_per_batch: int = 1000) -> DataFrame:
    """``doc_id, text`` of whole text files that appear in a folder."""
    read = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).text(folder, wholetext=True)
    return read.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def incoming_pdfs(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Binary PDFs that appear in a folder, as `pdf_texts` takes them."""
    return spark.readStream.format("binaryFile").option("pathGlobFilter", "*.pdf").option("maxFilesPerTrigger", files_per_batch).load(folder)


def parse_stream(texts: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append parsed documents (nested rows) to a Parquet table, each input file exactly once."""
    parsed = timesheet.parse_documents(texts)
    writer = parsed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
