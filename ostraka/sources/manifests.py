"""Manifests of downloaded images, the files they list, and the line files of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.operators.images import safe_relative_path

VERSION = 1
FILES = "array<struct<path:string,size:bigint,sha256:string>>"
ENTRY = f"struct<source_url:string,effective_url:string,scraper:string,source_ids:array<string>,scraped_at:string,files:{FILES}>"
MANIFEST = f"version int, entries array<{ENTRY}>"


def read_manifests(spark: SparkSession, pattern: str) -> DataFrame:
    """(directory, source_url, effective_url, scraper, source_ids, scraped_at, files) of all manifests that match.

    One that isn't an object, is of another version, or has no list of entries counts as empty.
    """
    raw = spark.read.text(pattern, wholetext=True).select(F.regexp_replace(F.input_file_name(), "/[^/]+$", "").alias("directory"), F.from_json("value", MANIFEST, {"mode": "PERMISSIVE"}).alias("m"))
    good = raw.filter(F.col("m.version") == VERSION)
    return good.select("directory", F.explode("m.entries").alias("e")).select("directory", "e.*").filter("source_url is not null")


def write_manifests(entries: DataFrame, target: str) -> None:
    """A manifest as JSON for each ``directory`` of the entries, under its name: they are those of one record.

    The entries of a manifest are ordered by source and effective address. Directories are spread over
    tasks; Spark's commit makes each file appear whole.
    """
    names = ("source_url", "effective_url", "scraper", "source_ids", "scraped_at", "files")
    whole = entries.groupBy("directory").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("entries")).select("directory", F.lit(VERSION).alias("version"), "entries")
    whole.write.mode("overwrite").partitionBy("directory").json(target)


def file_records(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """(path, size, sha256, modified) of the files under a folder, by path; paths that leave it are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(directory)
    path = F.element_at(F.split("path", "\\Q" + directory.rstrip("/") + "/\\E"), -1)
    return files.select(path.alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified")).filter(safe_relative_path(F.col("path")))


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that are new or whose size or time changed."""
    same = (after["path"] == before["path"]) & (after["size"] == before["size"]) & (after["modified"] == before["modified"])
    return after.join(before, same, "left_anti")


def write_lines(rows: DataFrame, line: Column, target: str) -> None:
    """Different lines of a run (left to do, in error, unavailable) as text, in order."""
    rows.select(line.alias("value")).distinct().orderBy("value").write.mode("overwrite").text(target)


def write_snippets(documents: DataFrame, target: str) -> None:
    """The XML of texts, a folder for each record."""
    documents.select("tm_id", F.col("xml_content").alias("value")).filter("value is not null").write.mode("errorifexists").partitionBy("tm_id").text(target)
