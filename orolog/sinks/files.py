"""Tables and reports to files.

Days and pairs go to CSV and nested rows to JSON through Spark's writers, partitioned by document, so that any
number of documents is written by the executors. Where exact file names are asked for (one folder for each
document, as the command line gives them), each document's files are written by the task that holds its row.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolog.functions import exprs as X
from orolog.operators import timesheet

CSV = {"header": True, "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "nullValue": "", "emptyValue": ""}
DAYS = ["year", "month", "day", "dow", "mo_f", "mo_t", "mo_lav", "raw"]
PAIRS = ["year", "month", "day", "dow", "pair_index", "entry_ts", "exit_ts", "duration_hhmm", "turno", "entry_raw", "exit_raw"]
#: Whole results are kept on the driver only up to this many employees; larger reports are written by `write_report_lines`.
DRIVER_EMPLOYEES = 100_000


def write_tables(parsed: DataFrame, out: str) -> None:
    """``out/days``, ``out/pairs`` (CSV) and ``out/report`` (JSON lines), partitioned by a safe form of the document's id.

    One folder for each document is what the form of output asks for; for more documents than a file system likes,
    write the tables themselves, which carry doc_id.
    """
    doc = X.safe_name(F.col("doc_id").cast("string")).alias("doc")
    for name, table, columns in (("days", timesheet.days_table(parsed), DAYS), ("pairs", timesheet.pairs_table(parsed), PAIRS)):
        table.select(doc, *columns).write.mode("overwrite").partitionBy("doc").options(**CSV).csv(f"{out}/{name}")
    parsed.select(doc, report_json(parsed).alias("value")).write.mode("overwrite").partitionBy("doc").text(f"{out}/report")


def totals_json(parsed: DataFrame) -> Column:
    """Only the totals that were found."""
    return F.to_json(parsed["totals"])


def report_json(parsed: DataFrame) -> Column:
    """Header, totals and validation; fields without a value are written as null."""
    return F.to_json(F.struct(parsed["meta"], parsed["totals"], parsed["validation"]), {"ignoreNullFields": "false"})


def write_documents(parsed: DataFrame, folder: Column, stem: Column | None = None) -> DataFrame:
    """Write the four files of every document that was read, where its row is; returns ``doc_id, files``.

    `folder` is an absolute path that all executors share; with `stem` the files are called ``<stem>.days.csv`` and
    so on. A file appears whole: it is written beside its name and then renamed, so a task may run again.
    """
    rows = parsed.where("status = 'success'")
    line = lambda columns, x: F.to_csv(F.struct(*(x[c] for c in columns)), {"escape": '"', "timestampNTZFormat": CSV["timestampNTZFormat"], "emptyValue": ""})
    year, month = F.col("meta.year").alias("year"), F.col("meta.month").alias("month")
    dated = lambda x: x.withField("year", year).withField("month", month)
    texts = rows.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        folder.alias("folder"),
        (F.concat(stem, F.lit(".")) if stem is not None else F.lit("")).alias("stem"),
        F.transform("days", lambda x: line(DAYS, dated(x))).alias("days"),
        F.transform("pairs", lambda x: line(PAIRS, dated(x))).alias("pairs"),
        totals_json(rows).alias("totals"),
        report_json(rows).alias("report"),
    )

    def write(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            done = []
            for r in batch.itertuples(index=False):
                os.makedirs(r.folder, exist_ok=True)
                table = lambda head, lines: "\n".join([",".join(head), *lines]) + "\n"
                pretty = lambda text: json.dumps(json.loads(text), indent=2, ensure_ascii=False)
                files = {"days.csv": table(DAYS, r.days), "pairs.csv": table(PAIRS, r.pairs), "totals.json": pretty(r.totals), "report.json": pretty(r.report)}
                for name, text in files.items():
                    write_whole(os.path.join(r.folder, r.stem + name), text)
                done.append((r.doc_id, len(files)))
            yield pd.DataFrame(done, columns=["doc_id", "files"])

    return texts.mapInPandas(write, "doc_id string, files int")


def write_whole(path: str, text: str) -> None:
    part = f"{path}.{os.getpid()}.part"
    with open(part, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(part, path)


def report_document(nested: DataFrame, root_id: str | None) -> dict:
    """A report or manifest as one document, employees in order. Its size is checked before it comes to the driver."""
    n = nested.count()
    if n > DRIVER_EMPLOYEES:
        raise ValueError(f"{n} employees are more than one document takes; use write_report_lines")
    spark: SparkSession = nested.sparkSession
    stamp = spark.range(1).select(X.utc_stamp().alias("t")).first()["t"]
    rows = nested.orderBy("place").select(F.to_json(F.struct("employee", "employee_id", "counts", *(c for c in nested.columns if isinstance(nested.schema[c].dataType, T.ArrayType))), {"ignoreNullFields": "false"}).alias("j")).collect()
    employees = [json.loads(r["j"]) for r in rows]
    for e in employees:
        for section in ("included", "skipped", "excluded_folders"):
            e[section] = [{k: v for k, v in x.items() if v is not None or k in ("file_id", "file_name")} if section != "excluded_folders" else {k: x.get(k) for k in ("folder_id", "folder_name", "reason")} for x in e.get(section) or []]
    return {"root_id": root_id, "generated_at": stamp, "employee_count": len(employees), "employees": employees}


def write_report(nested: DataFrame, root_id: str | None, path: str) -> dict:
    """One JSON file, replaced at once."""
    document = report_document(nested, root_id)
    write_whole(path, json.dumps(document, indent=2, ensure_ascii=False))
    return document


def write_report_lines(nested: DataFrame, path: str) -> None:
    """A report of any size: one JSON line for each employee."""
    nested.write.mode("overwrite").option("ignoreNullFields", False).json(path)
