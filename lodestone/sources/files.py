"""Readers. A missing or empty folder gives an empty table, unless asked to be strict.

Files without any content are not listed: Spark skips them.
"""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestone.functions.urls import relative_path
from lodestone.sources.document_files import NamedFiles, opened

PIECES = "file_path string, block bigint, id bigint, file_size bigint, part string"
RESULT_SCHEMA = "qid bigint, category string, question string, dorks string, urls array<string>, error string, slug string"


def _path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


# Scheme and authority in front of a path.
PREFIX = r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?"


def _below(column: Column, root: str) -> Column:
    """File path below ``root``, however the file system spells its scheme."""
    return relative_path(F.regexp_replace(column, PREFIX, ""), re.sub(PREFIX, "", root))


def _whole_files(spark: SparkSession, root: str, glob: str, strict: bool) -> DataFrame:
    if not _path_exists(spark, root):
        if strict:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], "path string, content binary")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.load(root).select("path", "content")


def read_json_documents(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """All ``*.json`` files below ``root`` as ``(file_path, content)``.

    Spark never lists names that start with an underscore, which category slugs may
    do; ``read_named_json`` does.
    """
    found = _whole_files(spark, root, "*.json", strict)
    return found.select(_below(F.col("path"), root).alias("file_path"), F.col("content").cast("string").alias("content"))


def read_json_pieces(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """All ``*.json`` files below ``root``, cut at closing braces: the form to use for large files.

    ``(file_path, block, id, file_size, part)`` for ``json_split.array_elements``. Spark
    splits a file into byte ranges, ``block`` being where one starts, and reads whole parts
    only, with any file system that it knows.
    """
    if not _path_exists(spark, root):
        if strict:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], PIECES)
    reader = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    return reader.text(root).select(
        _below(F.col("_metadata.file_path"), root).alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value").alias("part"),
    )


def read_named_json(spark: SparkSession, root: str) -> DataFrame:
    """Like ``read_json_documents``, names that begin with an underscore included.

    ``root`` is a path or URI that Arrow's file systems open on all machines. Only names
    that begin with a dot are left out, empty files are there; text that is not UTF-8 is null.
    """
    system, plain = opened(root)
    if system.get_file_info(plain).type != fs.FileType.Directory:
        raise FileNotFoundError(root)
    spark.dataSource.register(NamedFiles)
    return spark.read.format("named_files").option("suffix", ".json").load(root)


def read_json_file(spark: SparkSession, *paths: str) -> DataFrame:
    """Named JSON files as ``(doc, content)``."""
    return spark.read.text(list(paths), wholetext=True).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("content")
    )


def read_json_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One document per line as ``(doc, content)``: the form to use for large inputs.

    A whole JSON file is one task's work; lines are split over all of them.
    """
    # Within a block the low bits count its lines, so equal lines keep names of their own.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return spark.read.text(list(paths)).select(
        F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.lpad(row.cast("string"), 10, "0")).alias("doc"),
        F.col("value").alias("content"),
    )


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """All ``*.md`` files below ``root`` as ``(content_path, markdown)``; files that are not UTF-8 are skipped."""
    found = _whole_files(spark, root, "*.md", strict=False)
    text = F.col("content").cast("string")
    return found.where(F.is_valid_utf8(text)).select(_below(F.col("path"), root).alias("content_path"), text.alias("markdown"))


def read_generated_questions(spark: SparkSession, *paths: str, lines: bool = False) -> DataFrame:
    """``{question}`` objects: files of one JSON array each, or with ``lines`` of an object a line, as ``sinks.write_questions`` leaves them."""
    return spark.read.schema("question string").option("multiLine", str(not lines).lower()).json(list(paths))


def spread(scan: DataFrame) -> DataFrame:
    """Share a scan of few files among all cores; larger scans stay as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The page corpus that stands in for the web: ``(page_id, url, html)``."""
    return spread(spark.read.parquet(path).select("page_id", "url", "html"))


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """Recorded model replies, a parquet table of raw reply texts."""
    return spark.read.parquet(path)


def read_result_tables(spark: SparkSession, root: str) -> DataFrame:
    """Search results as ``sinks.write_results`` leaves them."""
    return spark.read.schema(RESULT_SCHEMA).json(root)
