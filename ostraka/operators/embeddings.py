"""Chunks of documents, their vectors, and the upkeep of a vector table by difference.

Vectors come from a callable ``embed(list of texts) -> list of vectors or None``; None means that
the text is too long for the model and keeps whatever it had. :func:`hash_embedder` needs no network.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.functions.text import CHUNK_WORDS, not_blank, word_chunks

KEY = ("xml_id", "model_name", "chunk_index")
COLUMNS = ("xml_id", "model_name", "chunk_index", "source_path", "tm_id", "language", "document_text", "input_hash", "embedding", "updated_at")
SAME = ("input_hash", "source_path", "tm_id", "language")
Embed = Callable[[list[str]], list]


def document_chunks(documents: DataFrame, model: str, language: Column, size: int = CHUNK_WORDS) -> DataFrame:
    """Chunk rows of documents (transcription_id, source_path, tm_id, text); blank texts give none."""
    rows = documents.filter(not_blank(F.col("text"))).select(
        F.col("transcription_id").alias("xml_id"), F.lit(model).alias("model_name"), F.posexplode(word_chunks(F.col("text"), size)).alias("chunk_index", "document_text"),
        "source_path", F.col("tm_id").cast("string").alias("tm_id"), language.alias("language"),
    )
    return rows.withColumn("input_hash", F.sha2("document_text", 256))


def sampled_records(documents: DataFrame, sample: int, seed: int = 0) -> DataFrame:
    """tm_ids that have a transcription and a translation, the first ``sample`` by MD5 of id and seed."""
    if sample < 1:
        raise ValueError("the sample must be positive")
    both = documents.groupBy("tm_id").agg(F.bool_or(F.col("type") == "transcription").alias("a"), F.bool_or(F.col("type") == "translation").alias("b")).filter("a and b")
    return both.select("tm_id").orderBy(F.md5(F.concat_ws(":", F.col("tm_id").cast("string"), F.lit(str(seed)))), "tm_id").limit(sample)


def stale(chunks: DataFrame, stored: DataFrame) -> DataFrame:
    """Chunks without an identical stored row (hash, path, record and language, nulls being equal)."""
    known = stored.select(*KEY, *[F.col(c).alias(f"__{c}") for c in SAME])
    condition = [chunks[k] == known[k] for k in KEY] + [chunks[c].eqNullSafe(known[f"__{c}"]) for c in SAME]
    return chunks.join(known, condition, "left_anti")


def surplus_chunks(stored: DataFrame, chunks: DataFrame) -> DataFrame:
    """Stored rows whose number their document no longer has, of documents that are in ``chunks``."""
    counts = chunks.groupBy("xml_id", "model_name").agg((F.max("chunk_index") + 1).alias("__n"))
    return stored.join(counts, ["xml_id", "model_name"]).filter(F.col("chunk_index") >= F.col("__n")).drop("__n")


def missing_sources(stored: DataFrame, seen: DataFrame, model: str) -> DataFrame:
    """Stored rows of the model whose document wasn't seen; with nothing seen, all of them."""
    return stored.filter(F.col("model_name") == model).join(seen.select("xml_id").distinct(), "xml_id", "left_anti")


def upserted(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows, those with a key of ``new`` replaced by it, and the rest of ``new``."""
    return stored.join(new.select(*KEY), list(KEY), "left_anti").unionByName(new)


def hash_embedder(dims: int = 16) -> Embed:
    """A stand-in for a model: vectors that depend on the text alone."""

    def embed(texts: list[str]) -> list:
        out = []
        for text in texts:
            seed = int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big")
            v = np.random.default_rng(seed).normal(size=dims)
            out.append((v / np.linalg.norm(v)).astype(np.float32))
        return out

    return embed


def embedded(chunks: DataFrame, embed: Embed, batch_rows: int = 64) -> DataFrame:
    """Chunks with ``embedding`` and ``skipped``; vectors must be finite and of one length in a batch."""
    schema = T.StructType([*chunks.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("skipped", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, batch_rows):
                part = batch.slice(begin, batch_rows)
                vectors = embed(part.column(part.schema.get_field_index("document_text")).to_pylist())
                sizes = {len(v) for v in vectors if v is not None}
                if len(sizes) > 1 or any(v is not None and not np.isfinite(np.asarray(v, dtype=float)).all() for v in vectors):
                    raise ValueError("vectors must be finite and of one length")
                columns = [*part.columns, pa.array(vectors, pa.list_(pa.float32())), pa.array([v is None for v in vectors])]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return chunks.mapInArrow(run, schema)


def refreshed(stored: DataFrame, chunks: DataFrame, model: str, embed: Embed, stale_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """(table after the refresh, rows embedded or skipped).

    Surplus chunks and rows of unseen documents of the model go first; what the model skips keeps
    its old row. The rows of other models stay.
    """
    seen = chunks.select("xml_id").distinct()
    gone = surplus_chunks(stored.filter(F.col("model_name") == model), chunks).select(*KEY).unionByName(missing_sources(stored, seen, model).select(*KEY))
    kept = stored.join(gone, list(KEY), "left_anti")
    work = embedded(stale(chunks, stored) if stale_only else chunks, embed)
    fresh = work.filter(~F.col("skipped")).withColumn("updated_at", F.current_timestamp()).select(*COLUMNS)
    return upserted(kept.select(*COLUMNS), fresh), work


def without_model(stored: DataFrame, model: str) -> DataFrame:
    return stored.filter(F.col("model_name") != model)


def first_embedding(stored: DataFrame, model: str, path: str) -> DataFrame:
    """The first vector of a document, by document and chunk; no row where there is none."""
    return stored.filter((F.col("model_name") == model) & (F.col("source_path") == path)).orderBy("xml_id", "chunk_index").limit(1).select("embedding")


def vector_statistics(stored: DataFrame) -> DataFrame:
    """Rows and least and greatest dimension of every model."""
    return stored.groupBy("model_name").agg(F.count(F.lit(1)).alias("rows"), F.min(F.size("embedding")).alias("min_dims"), F.max(F.size("embedding")).alias("max_dims"))


def deduplicated(stored: DataFrame) -> DataFrame:
    """One row for each key: the latest, of equally late ones the least hash."""
    newest = Window.partitionBy(*KEY).orderBy(F.desc("updated_at"), "input_hash", "embedding")
    return stored.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")


def vector_literal(vector: Sequence[float]) -> str:
    return "[" + ",".join(f"{x:.17g}" for x in vector) + "]"


def parsed_vector(literal: Column) -> Column:
    return F.from_json(literal, "array<double>")
