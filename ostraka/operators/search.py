"""Ranked text search (Okapi BM25) in documents chosen by their metadata.

Filters come before the statistics, so that the number of documents, their average length and the
document frequencies are those of the documents that are searched. The text is joined last, to the
few rows that are returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ostraka.functions.text import NO_WORD, lexemes
from ostraka.session import cut

K1, B = 1.2, 0.75
#: Results of at most so many rows are sent to all tasks; more are joined by a shuffle.
BROADCAST_ROWS = 10_000


@dataclass(frozen=True)
class MetadataFilter:
    """What the records of a document must have; every part that is given must hold.

    A date must overlap the years in one row that isn't an alternative.
    """

    material: str | None = None
    not_before_year: int | None = None
    not_after_year: int | None = None
    keywords: tuple[str, ...] = ()
    tm_place_ids: tuple[int, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "keywords", tuple(self.keywords))
        object.__setattr__(self, "tm_place_ids", tuple(self.tm_place_ids))
        if self.material is not None and not self.material.strip():
            raise ValueError("the material must not be empty")
        if self.not_before_year is not None and self.not_after_year is not None and self.not_before_year > self.not_after_year:
            raise ValueError("the years are reversed")
        if any(not k or not k.strip() for k in self.keywords):
            raise ValueError("keywords must not be empty")
        if any(p < 1 for p in self.tm_place_ids):
            raise ValueError("place ids must be positive")


def term_frequencies(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, lexeme, tf) of every lexeme of every document."""
    return documents.select(key, F.explode(lexemes(F.col(text))).alias("lexeme")).groupBy(key, "lexeme").agg(F.count(F.lit(1)).alias("tf"))


def term_positions(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, lexeme, positions): where, counted from 1, each lexeme stands."""
    places = documents.select(key, F.posexplode(lexemes(F.col(text))).alias("place", "lexeme"))
    return places.groupBy(key, "lexeme").agg(F.array_sort(F.collect_list(F.col("place") + 1)).alias("positions"))


def document_lengths(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Lexemes of every document whose text isn't null; 0 for a text without any."""
    return documents.filter(F.col(text).isNotNull()).select(key, F.size(lexemes(F.col(text))).cast("bigint").alias("length"))


def collection_statistics(lengths: DataFrame) -> DataFrame:
    return lengths.agg(F.count(F.lit(1)).alias("documents"), F.avg("length").alias("average_length"))


def document_frequencies(frequencies: DataFrame) -> DataFrame:
    return frequencies.groupBy("lexeme").agg(F.count(F.lit(1)).alias("df"))


def filtered(documents: DataFrame, wanted: MetadataFilter | None, metadata: dict[str, DataFrame], key: str = "tm_id") -> DataFrame:
    """Documents whose metadata fit, by left semi joins; ``metadata`` has papyri, orig_dates, keywords, orig_places."""
    if wanted is None:
        return documents
    out = documents

    def semi(table: str, condition: Column) -> DataFrame:
        rows = metadata[table].filter(condition).select(F.col("tm_id").cast(documents.schema[key].dataType).alias(key))
        return out.join(rows, key, "left_semi")

    if wanted.material is not None:
        out = semi("papyri", F.col("material") == wanted.material)
    if wanted.not_before_year is not None or wanted.not_after_year is not None:
        # a bound that a record leaves open fits every year, here also where both are
        first, last = F.col("not_before_year"), F.col("not_after_year")
        fits = ~F.col("alternative")
        if wanted.not_before_year is not None:
            fits = fits & (last.isNull() | (last >= wanted.not_before_year))
        if wanted.not_after_year is not None:
            fits = fits & (first.isNull() | (first <= wanted.not_after_year))
        out = semi("orig_dates", fits)
    if wanted.keywords:
        out = semi("keywords", F.col("keyword").isin(*wanted.keywords))
    if wanted.tm_place_ids:
        out = semi("orig_places", F.col("tm_place_id").isin(*wanted.tm_place_ids))
    return out


def query_lexemes(query: str) -> list[str]:
    """The different lexemes of a query, split as texts are."""
    import regex

    return sorted({w for w in regex.split(NO_WORD, query.lower()) if w})


def bm25_scores(documents: DataFrame, key: str, text: str, query: str) -> DataFrame:
    """(key, score) of the documents that have a lexeme of the query.

    Only documents whose text isn't null are searched. The texts are read once: each gives its length
    and the lexemes of the query that it holds, and these few values are kept; statistics and
    frequencies are counted from them.
    """
    wanted = query_lexemes(query)
    tokens = lexemes(F.col(text))
    hit = F.filter(tokens, lambda w: w.isin(*wanted)) if wanted else F.array().cast("array<string>")
    rows = cut(documents.filter(F.col(text).isNotNull()).select(key, F.size(tokens).cast("double").alias("length"), hit.alias("hits")))
    statistics = rows.agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg("length").alias("average")).first()
    count, average = F.lit(statistics["n"]), F.lit(statistics["average"])
    terms = rows.select(key, "length", F.explode("hits").alias("lexeme")).groupBy(key, "length", "lexeme").agg(F.count(F.lit(1)).cast("double").alias("tf"))
    frequencies = terms.groupBy("lexeme").agg(F.count(F.lit(1)).cast("double").alias("df"))
    # one row for each lexeme of the query: bounded by the query
    scored = terms.join(F.broadcast(frequencies), "lexeme")
    idf = F.ln(1 + (count - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.try_divide(F.col("length"), average)))
    # rounded, so that equal scores are equal in whatever order they were summed
    return scored.groupBy(key).agg(F.round(F.sum(idf * norm), 10).alias("score"))


def bm25_search(
    documents: DataFrame, *, query_text: str, limit: int, use_lemmas: bool = False, metadata_filter: MetadataFilter | None = None, metadata: dict[str, DataFrame] | None = None,
    key: str = "transcription_id", columns: Sequence[str] = ("source_path", "tm_id", "type", "language", "text"),
) -> DataFrame:
    """The best ``limit`` documents with their columns and score; of equal scores the lower key first."""
    if limit < 0:
        raise ValueError("the limit must not be negative")
    field = "lemma_text" if use_lemmas else "text"
    chosen = filtered(documents, metadata_filter, metadata or {})
    best = bm25_scores(chosen, key, field, query_text).orderBy(F.desc("score"), key).limit(limit)
    few = F.broadcast(best) if limit <= BROADCAST_ROWS else best
    return documents.join(few, key).select(key, *columns, "score").orderBy(F.desc("score"), key)
