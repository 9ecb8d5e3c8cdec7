"""Lemmas of texts by a pluggable pipeline, sentence by sentence, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.functions.text import normalize_language, sentence_chunks_of

#: A pipeline gives, for a sentence, its words as (string, lemma or None).
Pipeline = Callable[[str], list[tuple[str, str | None]]]
Factory = Callable[[str], Pipeline]


def lower_case_pipeline(_language: str) -> Pipeline:
    """A stand-in: every run of letters and figures in lower case is its lemma."""
    import regex

    return lambda sentence: [(w, w.lower()) for w in regex.findall(r"[\p{L}\p{M}\p{N}]+", sentence)]


def lemmatize_text(text: str, pipeline: Pipeline, max_words: int = 50) -> str:
    """Lemmas, the word itself where there is none, separated by blanks."""
    return " ".join(lemma or word for chunk in sentence_chunks_of(text, max_words) for word, lemma in pipeline(chunk))


def lemmatized(documents: DataFrame, language, factory: Factory = lower_case_pipeline, max_words: int = 50) -> DataFrame:
    """Documents with lemma_text filled in where it is null and the language has a pipeline.

    Other rows go through untouched; pipelines are made once in each worker.
    """
    if max_words < 1:
        raise ValueError("max_words must be at least 1")
    open_rows = F.col("lemma_text").isNull() & F.col("text").isNotNull()
    todo = documents.withColumn("__language", F.when(open_rows, normalize_language(language)))
    made: dict[str, Pipeline] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("lemma_text")
            texts, old = batch.column(batch.schema.get_field_index("text")).to_pylist(), batch.column(at).to_pylist()
            for i, code in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if code is not None:
                    if code not in made:
                        made[code] = factory(code)
                    old[i] = lemmatize_text(texts[i], made[code], max_words)
            columns = [pa.array(old, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    schema = T.StructType([f if f.name != "lemma_text" else T.StructField("lemma_text", T.StringType()) for f in documents.schema.fields])
    return todo.mapInArrow(run, schema)
