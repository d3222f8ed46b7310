"""Manifests, reports and match indexes: JSON documents with fixed schemas, flattened into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OUTPUTS = "struct<days_csv: string, pairs_csv: string, totals_json: string, report_json: string>"
ITEM = f"struct<file_id: string, file_name: string, mimeType: string, container: string, reason: string, outputs: {OUTPUTS}>"
FOLDER = "struct<folder_id: string, folder_name: string, reason: string>"
EMPLOYEE = f"struct<employee: string, name: string, employee_id: string, id: string, counts: struct<included: bigint, skipped_files: bigint, excluded_folders: bigint>, included: array<{ITEM}>, skipped: array<{ITEM}>, excluded_folders: array<{FOLDER}>>"
LEGACY = f"struct<status: string, employee: string, file_id: string, file_name: string, reason: string, outputs: {OUTPUTS}>"
REPORT = f"root_id string, generated_at string, employee_count bigint, employees array<{EMPLOYEE}>, files array<{LEGACY}>"
INDEX = "result struct<matches: array<struct<id: string, name: string, path: string, mimeType: string>>>"
#: An item of any section: files and folders in one struct, as merges need it.
ANY_ITEM = f"struct<file_id: string, file_name: string, mimeType: string, container: string, reason: string, outputs: {OUTPUTS}, folder_id: string, folder_name: string>"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The one row of a manifest; a missing file and broken JSON are errors."""
    return spark.read.schema(REPORT).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The one row of a report in either form; no row where the file doesn't exist, an error where it is broken."""
    return read_manifest(spark, path) if _exists(spark, path) else spark.createDataFrame([], REPORT)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``pos, id, name, path, mimeType`` of a match index; one without matches is an error."""
    read = spark.read.schema(INDEX).option("multiLine", True).option("mode", "FAILFAST").json(path)
    found = F.when(F.col("result.matches").isNull(), F.raise_error(F.lit("no result.matches"))).otherwise(F.col("result.matches"))
    return read.select(F.posexplode(found).alias("pos", "m")).select("pos", "m.*")


def employees_of(report: DataFrame) -> DataFrame:
    """``seq, employee, employee_id`` of the employees listed."""
    e = report.select(F.posexplode("employees").alias("seq", "e"))
    pick = lambda *names: F.coalesce(*(F.nullif(F.col(f"e.{n}"), F.lit("")) for n in names))
    return e.select("seq", pick("employee", "name").alias("employee"), pick("employee_id", "id").alias("employee_id"))


def items_of(report: DataFrame) -> DataFrame:
    """``seq, section, pos, file_id, item`` of all items listed."""
    e = report.select(F.posexplode("employees").alias("seq", "e"))
    none = F.lit(None).cast("string")
    parts = []
    for section in ("included", "skipped"):
        x = e.select("seq", F.posexplode(f"e.{section}").alias("pos", "x"))
        parts.append(x.select("seq", F.lit(section).alias("section"), "pos", F.col("x.file_id").alias("file_id"), F.struct("x.*", none.alias("folder_id"), none.alias("folder_name")).cast(ANY_ITEM).alias("item")))
    x = e.select("seq", F.posexplode("e.excluded_folders").alias("pos", "x"))
    blank = F.struct(none.alias("file_id"), none.alias("file_name"), none.alias("mimeType"), none.alias("container"), F.col("x.reason").alias("reason"), F.lit(None).cast(OUTPUTS).alias("outputs"), F.col("x.folder_id").alias("folder_id"), F.col("x.folder_name").alias("folder_name"))
    parts.append(x.select("seq", F.lit("excluded_folders").alias("section"), "pos", none.alias("file_id"), blank.cast(ANY_ITEM).alias("item")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def legacy_files_of(report: DataFrame) -> DataFrame:
    """``pos, status, employee, file_id, item`` of an older report's files; none where the newer list is there."""
    x = report.where("employees is null").select(F.posexplode("files").alias("pos", "x"))
    none = F.lit(None).cast("string")
    won = F.col("x.status") == "success"
    item = F.struct(
        F.col("x.file_id").alias("file_id"), F.col("x.file_name").alias("file_name"), none.alias("mimeType"), none.alias("container"),
        F.when(~won | won.isNull(), F.col("x.reason")).alias("reason"), F.when(won, F.col("x.outputs")).alias("outputs"), none.alias("folder_id"), none.alias("folder_name"),
    )
    return x.select("pos", "x.status", "x.employee", "x.file_id", item.cast(ANY_ITEM).alias("item"))
