"""A run over the images that records name: what is there, what is known to be broken, what is fetched.

Links come from the metadata of a corpus; the folder of images has a folder with a manifest for each
record. Fetching is a callable of the caller, which runs on the workers where the links lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.operators import images
from ostraka.session import cut
from ostraka.sources import corpus, manifests

#: (handler, tm_id, url) to the paths of the files it wrote, relative to the record's folder.
Fetch = Callable[[str, str, str], list[str]]


class Unavailable(Exception):
    """What a fetch raises when its site can't be reached at all; other errors are failures of one link."""


@dataclass(frozen=True)
class ImageRun:
    """Links with handler, outcome and error, and the new entries of manifests (none without fetching)."""

    links: DataFrame
    entries: DataFrame | None = None

    def counts(self) -> DataFrame:
        return images.outcome_counts(self.links.filter("handler is not null"))

    def write_lists(self, folder: str) -> None:
        """What is left to do, was unavailable, or failed, as lists of lines."""
        line = F.concat_ws(": ", "tm_id", "url")
        for name, outcome in (("todo", "todo"), ("unavailable", "unavailable"), ("error", "failed")):
            text = F.concat_ws(": ", line, "error") if name == "error" else line
            manifests.write_lines(self.links.filter(F.col("outcome") == outcome), text, f"{folder.rstrip('/')}/{name}")


def corpus_links(spark: SparkSession, source: str) -> DataFrame:
    """(tm_id, url) of the graphics in the metadata of all records of a corpus, each once."""
    found = corpus.records(spark, source).select("tm_id", F.col("metadata_path").alias("source_path"))
    files = corpus.xml_files(spark, source, corpus.HGV, True).unionByName(corpus.xml_files(spark, source, corpus.DCLP, True))
    return images.graphic_links(found.join(files, "source_path")).distinct()


def _known(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """Entries of the manifests under a folder, with paths from that folder on, and the files that are there."""
    files = manifests.file_records(spark, corpus.qualified(spark, target))
    try:
        entries = manifests.read_manifests(spark, f"{target.rstrip('/')}/*/manifest.json")
    except Exception as error:  # noqa: BLE001 - a folder without any manifest
        if "PATH_NOT_FOUND" not in str(error):
            raise
        entries = spark.createDataFrame([], f"directory string, source_url string, effective_url string, files {manifests.FILES}")
    own = F.element_at(F.split("directory", "/"), -1)
    inside = F.transform("files", lambda f: F.struct(F.concat(own, F.lit("/"), f["path"]).alias("path"), f["size"].alias("size"), f["sha256"].alias("sha256")))
    return entries.withColumn("files", inside), files


def run_images(spark: SparkSession, source: str, target: str, broken: DataFrame | None = None, fetch: Fetch | None = None) -> ImageRun:
    """Settles every link of a corpus; with ``fetch`` those that are queued are fetched and entered."""
    entries, files = _known(spark, target)
    dead = images.broken_entries(broken) if broken is not None else spark.createDataFrame([], "entry string")
    links = cut(images.image_run(corpus_links(spark, source), entries, files, dead))
    if fetch is None:
        return ImageRun(links.withColumn("error", F.lit(None).cast("string")))
    queued = links.filter("outcome = 'queued'").select("handler", "tm_id", "url")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        down: set[str] = set()  # handlers that were unavailable are left alone for the rest of a partition
        for batch in batches:
            rows = []
            for handler, tm_id, url in zip(*(c.to_pylist() for c in batch.columns)):
                result, paths, error = "downloaded", [], None
                try:
                    if handler in down:
                        raise Unavailable(handler)
                    paths = fetch(handler, tm_id, url)
                except Unavailable as reason:
                    down.add(handler)
                    result, error = "unavailable", str(reason)
                except Exception as reason:  # noqa: BLE001 - whatever a site does is the failure of one link
                    result, error = "failed", " ".join(str(reason).split()) or type(reason).__name__
                rows.append((tm_id, url, result, error, [f"{tm_id}/{p}" for p in paths]))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tm_id", "url", "result", "error", "paths"])

    # written once: fetching isn't repeated when results are read again
    fetched = cut(queued.mapInArrow(work, "tm_id string, url string, result string, error string, paths array<string>"))
    results = fetched.select("tm_id", "url", F.col("result").alias("__result"), "error")
    after = links.join(results, ["tm_id", "url"], "left").select("tm_id", "url", "handler", F.coalesce("__result", "outcome").alias("outcome"), "error")
    there = manifests.file_records(spark, corpus.qualified(spark, target))
    wrote = fetched.filter("result = 'downloaded'").select("tm_id", "url", F.explode("paths").alias("path")).join(there, "path")
    relative = F.expr("substring(path, length(tm_id) + 2)")
    handlers = links.select("tm_id", "url", "handler")
    new = wrote.groupBy("tm_id", "url").agg(F.array_sort(F.collect_list(F.struct(relative.alias("path"), "size", "sha256"))).alias("files")).join(handlers, ["tm_id", "url"])
    made = new.select(
        F.col("tm_id").alias("directory"), F.col("url").alias("source_url"), F.lit(None).cast("string").alias("effective_url"), F.col("handler").alias("scraper"), F.array(F.lit("graphic")).alias("source_ids"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("scraped_at"), "files",
    )
    return ImageRun(cut(after), cut(made))
