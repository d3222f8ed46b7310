"""A folder listing to included files, skipped files and excluded folders of each employee.

The listing is a table ``(id, parent_id, name, mime_type, trashed)``. Folders are walked down level by level by
an equi-join of the frontier with the listing's folders; an excluded folder leaves the frontier, so nothing
below it is ever read. Files are joined once, at the end.
"""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolog.functions import exprs as X

# What folders and PDFs are called.
FOLDER = "application/vnd.google-apps.folder"
PDF = "application/pdf"
# What an archive is called.
ZIPS = ["application/zip", "application/x-zip-compressed"]
# Terms that exclude a file or folder, in the order in which they are tried.
TERMS = ["cedolino", "cedolini", "busta", "buste", "paga", "busta paga", "buste paga"]


#: Levels after which the folders are counted, to tell a deep tree from a loop.
LOOKED_AT = 20
#: Levels after which lineage is cut, as a plan over many levels costs more than they do.
CUT_LEVELS = 6


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder that spark.checkpoint.dir names; a session in one JVM without it gets a folder of its own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="orolog-"))
    return df.checkpoint()


def folder_term(name: Column, terms: list[str]) -> Column:
    """The term that the normal form of a folder's name equals, or null."""
    normal = X.normal_term(name)
    return F.when(normal.isin(terms), normal) if terms else F.lit(None).cast("string")


def container(name: Column, mime: Column) -> Column:
    """'pdf' or 'zip' for files that count, null for all others."""
    return F.when(mime == PDF, "pdf").when(mime.isin(ZIPS) | F.lower(name).endswith(".zip"), "zip")


def children(listing: DataFrame, parent_id: str) -> DataFrame:
    return listing.where((F.col("parent_id") == parent_id) & ~F.coalesce(F.col("trashed"), F.lit(False)))


def employee_roots(listing: DataFrame, root_id: str) -> DataFrame:
    """``employee_id, employee`` of the folders right below the root."""
    return children(listing, root_id).where(F.col("mime_type") == FOLDER).select(F.col("id").alias("employee_id"), F.col("name").alias("employee"))


def walk(listing: DataFrame, roots: DataFrame, terms: list[str] = TERMS, held: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """All folders that are reached, and those that were excluded: ``employee_id, folder_id, folder_name, level[, reason]``.

    The employee's own folder is level 0 and can be excluded itself. A folder that is reached along two paths
    comes twice. Each level is one join, and the loop ends with the first empty one. Trees may be of any depth; a folder that
    lies within itself is an error, found when there are more levels than folders. Levels are persisted and
    added to `held`, for the caller to release when the results are written; every CUT_LEVELS-th is a checkpoint.
    """
    held = [] if held is None else held
    live = listing.where(~F.coalesce(F.col("trashed"), F.lit(False)) & (F.col("mime_type") == FOLDER)).select("parent_id", F.col("id").alias("folder_id"), F.col("name").alias("folder_name"))
    level = roots.select("employee_id", F.col("employee_id").alias("folder_id"), F.col("employee").alias("folder_name")).withColumn("level", F.lit(0))
    reached, excluded = [], []
    most, depth = None, 0
    while most is None or depth <= most:
        marked = level.withColumn("reason", folder_term(F.col("folder_name"), terms))
        excluded.append(marked.where("reason is not null"))
        kept = marked.where("reason is null").drop("reason")
        if depth % CUT_LEVELS == CUT_LEVELS - 1:
            kept = cut(kept)
        else:
            kept = kept.persist()
            held.append(kept)
        if kept.isEmpty():
            return reduce(DataFrame.unionByName, reached) if reached else kept, reduce(DataFrame.unionByName, excluded)
        reached.append(kept)
        level = kept.select("employee_id", F.col("folder_id").alias("parent_id")).join(live, "parent_id").select("employee_id", "folder_id", "folder_name").withColumn("level", F.lit(depth + 1))
        depth += 1
        if depth == LOOKED_AT:
            most = live.count() + 1
    raise ValueError("a folder lies within itself")


def scan(listing: DataFrame, root_id: str, terms: list[str] = TERMS, held: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Employees with their counts, their items, and the folders that were excluded.

    Items are ``employee_id, section, file_id, file_name, mimeType, container, reason``: a file is skipped for the
    first term that occurs in its lower-cased name; files of other kinds are left out without a trace. What is
    persisted on the way is added to `held`.
    """
    held = [] if held is None else held
    roots = employee_roots(listing, root_id).persist()
    held.append(roots)
    folders, excluded = walk(listing, roots, terms, held)
    files = listing.where(~F.coalesce(F.col("trashed"), F.lit(False)) & (F.col("mime_type") != FOLDER)).withColumn("kind", container(F.col("name"), F.col("mime_type"))).where("kind is not null")
    reason = X.first_term(F.col("name"), terms)
    items = folders.select("employee_id", F.col("folder_id").alias("parent_id")).join(files, "parent_id")
    items = items.select(
        "employee_id",
        F.when(reason.isNull(), "included").otherwise("skipped").alias("section"),
        F.col("id").alias("file_id"),
        F.col("name").alias("file_name"),
        F.col("mime_type").alias("mimeType"),
        F.when(F.col("kind") == "zip", "zip").alias("container"),
        reason.alias("reason"),
    )
    per = items.groupBy("employee_id").agg(F.count_if(F.col("section") == "included").alias("included"), F.count_if(F.col("section") == "skipped").alias("skipped_files"))
    gone = excluded.groupBy("employee_id").agg(F.count("*").alias("excluded_folders"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    employees = roots.join(per, "employee_id", "left").join(gone, "employee_id", "left").select("employee", "employee_id", zero("included"), zero("skipped_files"), zero("excluded_folders"))
    return employees, items, excluded.select("employee_id", "folder_id", "folder_name", "reason")


def pdf_matches(matches: DataFrame) -> DataFrame:
    """PDFs of a match index ``(pos, id, name, path, mimeType)`` in path order, case ignored, ties as they came; with the path to show."""
    shown = X.first_text(F.col("path"), F.col("name"), F.col("id"))
    return matches.where(F.col("mimeType") == PDF).orderBy(F.lower(F.coalesce("path", F.lit(""))), "pos").withColumn("shown", shown)
