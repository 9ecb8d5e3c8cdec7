"""Tables written to and read from exchange files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of the list of places.
GAZETTEER = T.StructType([T.StructField(n, T.StringType()) for n in (
    "id country region nomos_code name_latin name_standard full_name status ethnicon location unicode_greek unicode_egyptian unicode_coptic "
    "begin_date begin_date_format end_date end_date_format provincia coordinates"
).split()])
CSV = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "encoding": "UTF-8"}


def safe_name(value: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]+", "-", value).strip("-")


def dump_csv(df: DataFrame, target: str, columns: Sequence[str], order: Sequence[str]) -> None:
    """One folder of CSV parts in order; nulls are empty, empty strings are quoted, blanks at the ends of values stay."""
    options = {"header": True, "escape": '"', "emptyValue": '""', "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.select(*columns).orderBy(*order).write.mode("errorifexists").options(**options).csv(target)


def read_csv(spark: SparkSession, source: str, schema: T.StructType) -> DataFrame:
    """A dump; a header other than the schema's columns, in order, is an error."""
    found = spark.read.options(**CSV).csv(source).columns
    if found != schema.fieldNames():
        raise ValueError(f"{source} has the columns {found}, not {schema.fieldNames()}")
    return spark.read.options(**CSV, enforceSchema="true").schema(schema).csv(source)


def read_gazetteer(spark: SparkSession, source: str) -> DataFrame:
    """A list of places from CSV: a byte order mark and semicolons at ends are dropped, blanks are null."""
    raw = spark.read.options(**CSV).csv(source)
    names = [re.sub(r";+$", "", c.lstrip("\ufeff").strip()) for c in raw.columns]
    if names != GAZETTEER.fieldNames():
        raise ValueError(f"{source} has the columns {names}")
    numbers = {"id", "begin_date", "end_date"}
    clean = [F.nullif(F.trim(F.regexp_replace(F.col(f"`{c}`"), ";+$", "")), F.lit("")).alias(n) for c, n in zip(raw.columns, names)]
    return raw.select(*clean).select(*[F.col(n).try_cast("int").alias(n) if n in numbers else F.col(n) for n in names])


def dump_embeddings(vectors: DataFrame, target: str, model: str) -> int:
    """The vectors of one model as Parquet, in order of their keys; the number of rows."""
    rows = vectors.filter(F.col("model_name") == model)
    rows.orderBy("xml_id", "chunk_index").write.mode("errorifexists").parquet(target)
    return rows.count()


def import_embeddings(spark: SparkSession, source: str, stored: DataFrame, model: str) -> DataFrame:
    """The stored table with the model's rows replaced by a dump of that model with vectors of one length."""
    new = spark.read.parquet(source)
    check = new.agg(F.collect_set("model_name").alias("models"), F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high")).first()
    if check["models"] != [model] or check["low"] != check["high"]:
        raise ValueError(f"{source} holds models {check['models']} with {check['low']} to {check['high']} dimensions")
    return stored.filter(F.col("model_name") != model).unionByName(new)


def copy_tables(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> None:
    """Whole tables from one folder to another that doesn't hold them yet."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    files = make(target).getFileSystem(spark._jsc.hadoopConfiguration())
    taken = [n for n in names if files.exists(make(f"{target.rstrip('/')}/{n}.parquet"))]
    if taken:
        raise FileExistsError(f"{target} already holds {taken}")
    for name in names:
        spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet").write.parquet(f"{target.rstrip('/')}/{name}.parquet")
