"""Records of a corpus folder: metadata, transcription and translations put together."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.functions.text import not_blank, partition_name, xml_normalized
from ostraka.operators import render

#: The folders of a corpus.
HGV, DDBDP, TRANSLATIONS, DCLP = "HGV_meta_EpiDoc", "DDbDP", "Translations", "DCLP"


def qualified(spark: SparkSession, root: str) -> str:
    """A folder with the scheme of its file system, which may be a shared one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def require_directories(spark: SparkSession, root: str, names: tuple[str, ...] = (HGV, DDBDP, TRANSLATIONS, DCLP)) -> None:
    make = spark._jvm.org.apache.hadoop.fs.Path
    files = make(root).getFileSystem(spark._jsc.hadoopConfiguration())
    missing = [n for n in names if not files.isDirectory(make(f"{root.rstrip('/')}/{n}"))]
    if missing:
        raise FileNotFoundError(f"{root} lacks: {', '.join(missing)}")


def xml_files(spark: SparkSession, root: str, pattern: str, recursive: bool = False) -> DataFrame:
    """(source_path, xml) of the files that match; paths are relative to the root, a byte order mark is dropped."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    # "file:/x" and "file:///x" are one folder
    base = re.sub("^file:/+", "file:/", qualified(spark, root)) + "/"
    path = F.regexp_replace(F.col("path"), "^file:/+", "file:/")
    text = F.regexp_replace(F.decode("content", "UTF-8"), "\\A\\x{FEFF}", "")
    return reader.load(f"{qualified(spark, root)}/{pattern}").select(F.substr(path, F.lit(len(base) + 1)).alias("source_path"), text.alias("xml"))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.xml$", "")


def tm_id_of(xml: Column) -> Column:
    return F.nullif(xml_normalized(F.xpath_string(xml, F.lit("(//*[local-name()='idno'][@type='TM'])[1]"))), F.lit(""))


def translation_groups(translations: DataFrame) -> DataFrame:
    """(hgv_id, translation_paths): files named <id>-<number>, paths in order; others are left out."""
    name = stem(F.col("source_path"))
    rows = translations.select(F.regexp_extract(name, r"^(.+)-([0-9]+)$", 1).alias("hgv_id"), "source_path").filter("hgv_id <> ''")
    return rows.groupBy("hgv_id").agg(F.array_sort(F.collect_list("source_path")).alias("translation_paths"))


def associate(metadata: DataFrame, transcriptions: DataFrame, translations: DataFrame) -> DataFrame:
    """HGV records: (tm_id, metadata_path, transcription_path, translation_paths, source_rank 0).

    ``metadata`` has tm_id and source_path, ``transcriptions`` source_path and has_edition; a
    transcription counts when its edition isn't empty. Files are joined by name, once for each.
    """
    wanted = F.concat(F.lit(f"{DDBDP}/"), partition_name(F.col("tm_id")), F.lit("/"), F.col("tm_id"), F.lit(".xml"))
    editions = transcriptions.filter("has_edition").select(F.col("source_path").alias("transcription_path"))
    records = metadata.select("tm_id", F.col("source_path").alias("metadata_path"), wanted.alias("__wanted"), stem(F.col("source_path")).alias("hgv_id"))
    joined = records.join(editions, F.col("__wanted") == F.col("transcription_path"), "left").join(translation_groups(translations), "hgv_id", "left")
    return joined.select("tm_id", "metadata_path", "transcription_path", F.coalesce("translation_paths", F.array().cast("array<string>")).alias("translation_paths"), F.lit(0).alias("source_rank"))


def records(spark: SparkSession, root: str) -> DataFrame:
    """All records, those of HGV before those of DCLP, whose metadata file is its own transcription.

    Their order is (source_rank, path parts); a metadata file without a TM id fails the query.
    """
    require_directories(spark, root)
    missing = F.raise_error(F.concat(F.lit("no TM id in "), F.col("source_path"))).cast("string")
    with_id = lambda files: files.withColumn("tm_id", F.coalesce(tm_id_of(F.col("xml")), missing))
    hgv = with_id(xml_files(spark, root, f"{HGV}/HGV*")).select("tm_id", "source_path")
    texts = xml_files(spark, root, DDBDP, recursive=True).select("source_path", render.edition_present(F.col("xml")).alias("has_edition"))
    translations = xml_files(spark, root, TRANSLATIONS, recursive=True).select("source_path")
    dclp = with_id(xml_files(spark, root, DCLP, recursive=True)).select(
        "tm_id", F.col("source_path").alias("metadata_path"), F.when(render.edition_present(F.col("xml")), F.col("source_path")).alias("transcription_path"), F.array().cast("array<string>").alias("translation_paths"), F.lit(1).alias("source_rank")
    )
    return associate(hgv, texts, translations).unionByName(dclp)


def in_order(found: DataFrame) -> DataFrame:
    return found.orderBy("source_rank", F.split("metadata_path", "/"))


def document_table(found: DataFrame, files: DataFrame) -> DataFrame:
    """Texts of the records: source_path, tm_id, xml_content, type, language, text; blank ones are left out."""
    text = F.col("xml")
    editions = found.filter("transcription_path is not null").select("tm_id", F.col("transcription_path").alias("source_path")).join(files, "source_path")
    own = editions.withColumn("xml_content", render.snippet(text)).select("source_path", "tm_id", "xml_content", F.lit("transcription").alias("type"), F.lit(None).cast("string").alias("language"), render.render_edition(F.col("xml_content")).alias("text"))
    paths = F.when(F.col("source_rank") == 1, F.concat(F.array("metadata_path"), "translation_paths")).otherwise(F.col("translation_paths"))
    parts = found.select("tm_id", F.explode(paths).alias("source_path")).join(files, "source_path").select("source_path", "tm_id", F.explode(render.snippets(text)).alias("part"))
    other = parts.select("source_path", "tm_id", F.col("part.xml").alias("xml_content"), F.lit("translation").alias("type"), F.col("part.lang").alias("language"), render.render_translation(F.col("part.xml")).alias("text"))
    return own.unionByName(other).filter(not_blank(F.col("text"))).withColumn("tm_id", F.col("tm_id").cast("bigint"))
