"""Writers. Each writes to its own folder; large groups become several part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, functions as F

from lodestone.operators.url_records import filed_results
from lodestone.sources.document_files import DocumentFiles

FILE_ROWS = 1_000_000
# Files of one folder at least where it has many rows: a folder is shared by so many tasks.
FOLDER_TASKS = 8


def _filed(results: DataFrame, pos: str) -> DataFrame:
    return filed_results(results, pos).withColumn("slug", F.regexp_replace("file_path", r"\.json$", "")).drop("file_path")


def _by_folder(rows: DataFrame, folders: list[str], pos: str) -> DataFrame:
    """Rows of a folder in a few tasks, so that the number of files doesn't grow with that of tasks."""
    return rows.repartition(*folders, F.pmod(F.xxhash64(pos), F.lit(FOLDER_TASKS)))


def _replacing(rows: DataFrame) -> DataFrameWriter:
    """A writer that replaces the folders it writes to and leaves all others."""
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_ROWS)


def write_results(results: DataFrame, target: str, pos: str = "qid") -> None:
    """Search results as JSON lines in one folder per category slug.

    A folder replaced by a later category with the same slug holds that category only.
    Folders of categories that are not among the results stay as they are.
    """
    _replacing(_by_folder(_filed(results, pos), ["slug"], pos)).partitionBy("slug").json(target)


def write_engine_results(results: DataFrame, target: str, pos: str = "qid") -> None:
    """Results of several engines, one folder per engine and slug; other folders stay."""
    _replacing(_by_folder(_filed(results, pos), ["engine", "slug"], pos)).partitionBy("engine", "slug").json(target)


def write_documents(documents: DataFrame, target: str) -> None:
    """Documents as a table: the form for large runs."""
    documents.select("content_path", "markdown").write.mode("overwrite").parquet(target)


def write_markdown_files(documents: DataFrame, target: str, mode: str = "append") -> None:
    """One ``.md`` file per document, below a path or URI that Arrow's file systems open.

    ``documents`` holds one row per path. Files appear under their names when all of them
    are written; a file of the same name is replaced, with ``overwrite`` all others go too.
    """
    documents.sparkSession.dataSource.register(DocumentFiles)
    documents.select("content_path", "markdown").write.format("document_files").mode(mode).save(target)


def write_blocks(blocks: DataFrame, target: str) -> None:
    """Nested blocks (metadata or categorised questions) as JSON lines, nulls kept."""
    blocks.write.mode("overwrite").option("ignoreNullFields", "false").json(target)


def write_pairs(pairs: DataFrame, target: str) -> None:
    """Question and answer pairs as JSON lines."""
    pairs.select("q", "a").write.mode("overwrite").option("ignoreNullFields", "false").json(target)


def write_questions(questions: DataFrame, target: str) -> None:
    """Generated questions as JSON lines."""
    questions.select("question").write.mode("overwrite").option("ignoreNullFields", "false").json(target)
