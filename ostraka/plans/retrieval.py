"""Search, chunks, upkeep of vectors, and retrieval measures on the corpus tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.operators import embeddings, evaluate, search
from ostraka.sources.tables import table

QUERY = "πυροῦ ἀρτάβας δραχμῶν τὸν μισθὸν"
SPLIT = r"'[^\p{L}\p{M}\p{N}]+'"


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "transcriptions")


def _best(spark: SparkSession, root: str, **wanted) -> DataFrame:
    metadata = {n: table(spark, root, n) for n in ("papyri", "orig_places")}
    places, geo = metadata["orig_places"], table(spark, root, "export_geo").select(F.col("id").alias("tm_place_id"), F.col("begin_date").alias("not_before_year"), F.col("end_date").alias("not_after_year"))
    metadata["orig_dates"] = places.join(geo, "tm_place_id").select("tm_id", "not_before_year", "not_after_year", (F.col("granularity") == "region").alias("alternative"))
    metadata["keywords"] = places.select("tm_id", F.col("place_type").alias("keyword"))
    found = search.bm25_search(_documents(spark, root), query_text=QUERY, limit=20, metadata=metadata, columns=("source_path", "tm_id", "type", "language"), **wanted)
    return found.withColumn("score", F.round("score", 6))


def bm25_topk(spark: SparkSession, root: str) -> DataFrame:
    return _best(spark, root)


def bm25_lemma_topk(spark: SparkSession, root: str) -> DataFrame:
    return _best(spark, root, use_lemmas=True)


def bm25_material_topk(spark: SparkSession, root: str) -> DataFrame:
    return _best(spark, root, metadata_filter=search.MetadataFilter(material="papyrus"))


def bm25_dates_topk(spark: SparkSession, root: str) -> DataFrame:
    """Documents of records that name a place that existed in the years 101 to 300; the bounds of places stand for dates."""
    return _best(spark, root, metadata_filter=search.MetadataFilter(not_before_year=101, not_after_year=300))


def bm25_keywords_topk(spark: SparkSession, root: str) -> DataFrame:
    """Documents of records with certain kinds of places; the kinds stand for keywords."""
    return _best(spark, root, metadata_filter=search.MetadataFilter(keywords=KINDS))


def bm25_all_filters(spark: SparkSession, root: str) -> DataFrame:
    wanted = search.MetadataFilter(material="papyrus", not_before_year=-200, keywords=KINDS, tm_place_ids=PLACES)
    return _best(spark, root, metadata_filter=wanted)


def bm25_places_topk(spark: SparkSession, root: str) -> DataFrame:
    return _best(spark, root, metadata_filter=search.MetadataFilter(tm_place_ids=PLACES))


PLACES = (464, 7120, 6708, 2655)
KINDS = ("found", "composed")


def _bm25_sql(field: str, where: str = "") -> str:
    terms = ", ".join(f"'{w}'" for w in search.query_lexemes(QUERY))
    return f"""
WITH docs AS (SELECT transcription_id, list_filter(regexp_split_to_array(lower({field}), {SPLIT}), lambda w: w <> '') AS words FROM transcriptions t WHERE {field} IS NOT NULL {where}),
lens AS (SELECT transcription_id, len(words)::DOUBLE AS length FROM docs),
stats AS (SELECT count(*)::DOUBLE AS n, avg(length) AS average FROM lens),
terms AS (SELECT transcription_id, w AS lexeme, count(*)::DOUBLE AS tf FROM (SELECT transcription_id, unnest(words) AS w FROM docs) WHERE w IN ({terms}) GROUP BY ALL),
df AS (SELECT lexeme, count(*)::DOUBLE AS df FROM terms GROUP BY lexeme),
scores AS (SELECT transcription_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average))), 10) AS score
  FROM terms JOIN df USING (lexeme) JOIN lens USING (transcription_id) CROSS JOIN stats GROUP BY transcription_id ORDER BY score DESC, transcription_id LIMIT 20)
SELECT transcription_id, source_path, tm_id, type, language, round(score, 6) AS score FROM scores JOIN transcriptions USING (transcription_id)"""


def term_frequencies(spark: SparkSession, root: str) -> DataFrame:
    return search.term_frequencies(_documents(spark, root), "transcription_id", "text")


def term_positions(spark: SparkSession, root: str) -> DataFrame:
    rows = search.term_positions(_documents(spark, root), "transcription_id", "text")
    return rows.select("transcription_id", "lexeme", F.array_join(F.transform("positions", lambda x: x.cast("string")), ",").alias("positions"))


def document_lengths(spark: SparkSession, root: str) -> DataFrame:
    return search.document_lengths(_documents(spark, root), "transcription_id", "text")


def document_frequencies(spark: SparkSession, root: str) -> DataFrame:
    return search.document_frequencies(search.term_frequencies(_documents(spark, root), "transcription_id", "text"))


def collection_statistics(spark: SparkSession, root: str) -> DataFrame:
    s = search.collection_statistics(search.document_lengths(_documents(spark, root), "transcription_id", "text"))
    return s.select("documents", F.round("average_length", 6).alias("average_length"))


def chunk_words(spark: SparkSession, root: str) -> DataFrame:
    d = _documents(spark, root).withColumn("language", F.col("language"))
    chunks = embeddings.document_chunks(d, "any", F.col("language"))
    return chunks.select("xml_id", "chunk_index", "input_hash", "tm_id", "source_path")


def chunk_counts(spark: SparkSession, root: str) -> DataFrame:
    return chunk_words(spark, root).groupBy("xml_id").agg(F.count(F.lit(1)).alias("chunks"))


BLANKS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_CHUNKS_SQL = f"""
WITH words AS (SELECT transcription_id AS xml_id, source_path, tm_id::VARCHAR AS tm_id, text, list_filter(regexp_split_to_array(text, '{BLANKS}'), lambda w: w <> '') AS w FROM transcriptions WHERE regexp_replace(text, '{BLANKS}', '', 'g') <> ''),
starts AS (SELECT *, unnest(CASE WHEN len(w) <= 500 THEN [0] ELSE range(0, ceil((len(w) - 500) / 450.0)::BIGINT + 1) END) AS chunk_index FROM words)
SELECT xml_id, chunk_index::INTEGER AS chunk_index, sha256(CASE WHEN len(w) <= 500 THEN text ELSE array_to_string(w[chunk_index * 450 + 1:chunk_index * 450 + 500], ' ') END) AS input_hash, tm_id, source_path FROM starts"""


def sampled_records(spark: SparkSession, root: str) -> DataFrame:
    """A sampling operator: the limit is what it is for."""
    return embeddings.sampled_records(_documents(spark, root), 100, 0)


def _stored(spark: SparkSession, root: str) -> DataFrame:
    """The vectors of all texts, each key once."""
    both = table(spark, root, "transcription_embeddings").unionByName(table(spark, root, "translation_embeddings"))
    return embeddings.deduplicated(both)


def _models(stored: DataFrame) -> list[str]:
    return sorted(r["model_name"] for r in stored.select("model_name").distinct().collect())


def stale_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Chunks of the stored table whose language would now be read as en where it is en-GB."""
    stored = _stored(spark, root)
    chunks = stored.withColumn("language", F.when(F.col("language") == "en-GB", "en").otherwise(F.col("language")))
    return embeddings.stale(chunks, stored).select(*embeddings.KEY)


def upserted_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Vectors of transcriptions, with those of translations put over them."""
    old = embeddings.deduplicated(table(spark, root, "transcription_embeddings"))
    new = embeddings.deduplicated(table(spark, root, "translation_embeddings"))
    return embeddings.upserted(old, new).select(*embeddings.KEY, "input_hash")


def surplus_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Stored chunks of every model beyond the number that the texts have in chunks of 1,000 words."""
    stored, d = _stored(spark, root), _documents(spark, root)
    chunks = reduce(DataFrame.unionByName, [embeddings.document_chunks(d, m, F.col("language"), 1000) for m in _models(stored)])
    return embeddings.surplus_chunks(stored, chunks).select(*embeddings.KEY)


def first_vectors(spark: SparkSession, root: str) -> DataFrame:
    """The first vector of one document in every model, as text; its components are those stored."""
    stored = table(spark, root, "translation_embeddings")
    path = stored.agg(F.min("source_path")).first()[0]
    found = [embeddings.first_embedding(embeddings.deduplicated(stored), m, path).select(F.lit(m).alias("model_name"), F.size("embedding").alias("dims"), F.element_at("embedding", 1).cast("double").alias("first")) for m in _models(stored)]
    return reduce(DataFrame.unionByName, found)


def missing_sources(spark: SparkSession, root: str) -> DataFrame:
    """Stored vectors of texts that aren't English."""
    seen = _documents(spark, root).filter("language = 'en'").select(F.col("transcription_id").alias("xml_id"))
    stored = _stored(spark, root)
    return reduce(DataFrame.unionByName, [embeddings.missing_sources(stored, seen, m).select(*embeddings.KEY) for m in _models(stored)])


def vector_statistics(spark: SparkSession, root: str) -> DataFrame:
    return embeddings.vector_statistics(_stored(spark, root))


def _sides(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    keep = ("model_name", "tm_id", "source_path", "language", "xml_id", "chunk_index", "embedding", "updated_at", "input_hash")
    return tuple(embeddings.deduplicated(table(spark, root, n).select(*keep)) for n in ("transcription_embeddings", "translation_embeddings"))


def collection_dims(spark: SparkSession, root: str) -> DataFrame:
    found = [evaluate.collection_statistics(side).withColumn("side", F.lit(name)) for name, side in zip(("transcriptions", "translations"), _sides(spark, root))]
    return found[0].unionByName(found[1])


def query_documents(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.query_documents(*_sides(spark, root))


def translation_ranks(spark: SparkSession, root: str) -> DataFrame:
    ranks = evaluate.target_ranks(*_sides(spark, root))
    return ranks.select("model_name", "tm_id", "chunks", "rank", "language_label", "chunk_group")


def nearest_translations(spark: SparkSession, root: str) -> DataFrame:
    """The five nearest records of every query document, in order."""
    ranks = evaluate.target_ranks(*_sides(spark, root))
    return ranks.select("model_name", "tm_id", F.posexplode("nearest").alias("place", "n")).select("model_name", "tm_id", (F.col("place") + 1).alias("place"), F.col("n.tm_id").alias("near"), F.round("n.distance", 6).alias("distance"))


def retrieval_measures(spark: SparkSession, root: str) -> DataFrame:
    found = evaluate.retrieval_measures(evaluate.target_ranks(*_sides(spark, root)))
    return found.select("model_name", "slice_kind", "slice_value", "queries", *[F.round(c, 6).alias(c) for c in ("recall_1", "recall_5", "mrr")])


QUERIES = {f.__name__: f for f in (
    bm25_topk, bm25_lemma_topk, bm25_material_topk, bm25_places_topk, bm25_dates_topk, bm25_keywords_topk, bm25_all_filters, term_frequencies, term_positions, document_lengths, document_frequencies, collection_statistics,
    chunk_words, chunk_counts, sampled_records, stale_chunks, upserted_vectors, surplus_chunks, missing_sources, first_vectors, vector_statistics, collection_dims, query_documents,
    translation_ranks, nearest_translations, retrieval_measures,
)}
_KEY = "xml_id, model_name, chunk_index"
_DEDUP = "(SELECT * FROM {} QUALIFY row_number() OVER (PARTITION BY xml_id, model_name, chunk_index ORDER BY updated_at DESC, input_hash, embedding) = 1)"
_ALL = "(SELECT * FROM (SELECT * FROM transcription_embeddings UNION ALL BY NAME SELECT * FROM translation_embeddings) QUALIFY row_number() OVER (PARTITION BY xml_id, model_name, chunk_index ORDER BY updated_at DESC, input_hash, embedding) = 1)"
_DATED = "EXISTS (SELECT 1 FROM orig_places p JOIN export_geo g ON p.tm_place_id = g.id WHERE p.tm_id = t.tm_id AND p.granularity <> 'region' AND {})"
_KIND = "EXISTS (SELECT 1 FROM orig_places p WHERE p.tm_id = t.tm_id AND p.place_type IN ('found', 'composed'))"
_OLD, _NEW = _DEDUP.format("transcription_embeddings"), _DEDUP.format("translation_embeddings")
_RANKS = f"""
WITH a AS {_OLD}, b AS {_NEW},
q AS (SELECT model_name, tm_id, min(source_path) AS source_path, min(language) AS language, count(*) AS chunks FROM a WHERE (model_name, tm_id) IN (SELECT (model_name, tm_id) FROM b) GROUP BY ALL),
va AS (SELECT model_name, tm_id, embedding::DOUBLE[] AS v FROM a WHERE list_aggregate([abs(x) FOR x IN embedding], 'max') > 0),
vb AS (SELECT model_name, tm_id, embedding::DOUBLE[] AS v FROM b WHERE list_aggregate([abs(x) FOR x IN embedding], 'max') > 0),
d AS (SELECT va.model_name, va.tm_id AS q, vb.tm_id AS c, round(min(1 - list_cosine_similarity(va.v, vb.v)), 10) AS distance FROM va JOIN vb USING (model_name) JOIN q ON q.model_name = va.model_name AND q.tm_id = va.tm_id GROUP BY ALL),
r AS (SELECT model_name, q AS tm_id, c, row_number() OVER (PARTITION BY model_name, q ORDER BY distance, c) AS rank FROM d),
ranks AS (SELECT q.model_name, q.tm_id, q.chunks, rank::INTEGER AS rank, 'unknown' AS language_label, CASE WHEN chunks = 1 THEN '1 chunk' WHEN chunks <= 3 THEN '2-3 chunks' ELSE '4+ chunks' END AS chunk_group
  FROM q LEFT JOIN r ON r.model_name = q.model_name AND r.tm_id = q.tm_id AND r.c = q.tm_id)"""
SQL = {
    "bm25_topk": _bm25_sql("text"),
    "bm25_lemma_topk": _bm25_sql("lemma_text"),
    "bm25_material_topk": _bm25_sql("text", "AND EXISTS (SELECT 1 FROM papyri p WHERE p.tm_id = t.tm_id AND p.material = 'papyrus')"),
    "bm25_places_topk": _bm25_sql("text", f"AND EXISTS (SELECT 1 FROM orig_places p WHERE p.tm_id = t.tm_id AND p.tm_place_id IN {PLACES})"),
    "bm25_dates_topk": _bm25_sql("text", "AND " + _DATED.format("(g.end_date IS NULL OR g.end_date >= 101) AND (g.begin_date IS NULL OR g.begin_date <= 300)")),
    "bm25_keywords_topk": _bm25_sql("text", f"AND {_KIND}"),
    "bm25_all_filters": _bm25_sql("text", f"AND EXISTS (SELECT 1 FROM papyri p WHERE p.tm_id = t.tm_id AND p.material = 'papyrus') AND {_DATED.format('(g.end_date IS NULL OR g.end_date >= -200)')} AND {_KIND} AND EXISTS (SELECT 1 FROM orig_places p WHERE p.tm_id = t.tm_id AND p.tm_place_id IN {PLACES})"),
    "term_frequencies": f"SELECT transcription_id, w AS lexeme, count(*) AS tf FROM (SELECT transcription_id, unnest(regexp_split_to_array(lower(text), {SPLIT})) AS w FROM transcriptions) WHERE w <> '' GROUP BY ALL",
    "term_positions": f"""SELECT transcription_id, w AS lexeme, string_agg(i::VARCHAR, ',' ORDER BY i) AS positions FROM (SELECT transcription_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM
        (SELECT transcription_id, list_filter(regexp_split_to_array(lower(text), {SPLIT}), lambda x: x <> '') AS words FROM transcriptions)) GROUP BY ALL""",
    "document_lengths": f"SELECT transcription_id, len(list_filter(regexp_split_to_array(lower(text), {SPLIT}), lambda w: w <> '')) AS length FROM transcriptions WHERE text IS NOT NULL",
    "document_frequencies": f"SELECT w AS lexeme, count(DISTINCT transcription_id) AS df FROM (SELECT transcription_id, unnest(regexp_split_to_array(lower(text), {SPLIT})) AS w FROM transcriptions) WHERE w <> '' GROUP BY w",
    "collection_statistics": f"SELECT count(*) AS documents, round(avg(len(list_filter(regexp_split_to_array(lower(text), {SPLIT}), lambda w: w <> ''))), 6) AS average_length FROM transcriptions WHERE text IS NOT NULL",
    "chunk_words": _CHUNKS_SQL,
    "chunk_counts": f"SELECT xml_id, count(*) AS chunks FROM ({_CHUNKS_SQL}) GROUP BY xml_id",
    "sampled_records": "SELECT tm_id FROM transcriptions GROUP BY tm_id HAVING bool_or(type = 'transcription') AND bool_or(type = 'translation') ORDER BY md5(tm_id || ':0'), tm_id LIMIT 100",
    "stale_chunks": f"SELECT {_KEY} FROM {_ALL} WHERE language = 'en-GB'",
    "upserted_vectors": f"SELECT {_KEY}, input_hash FROM {_NEW} UNION ALL SELECT {_KEY}, input_hash FROM {_OLD} WHERE (xml_id, model_name, chunk_index) NOT IN (SELECT (xml_id, model_name, chunk_index) FROM translation_embeddings)",
    "surplus_chunks": f"""WITH n AS (SELECT transcription_id AS xml_id, len(list_filter(regexp_split_to_array(text, '{BLANKS}'), lambda w: w <> '')) AS w FROM transcriptions)
        SELECT e.xml_id, e.model_name, e.chunk_index FROM {_ALL} e JOIN n USING (xml_id) WHERE w > 0 AND chunk_index >= CASE WHEN w <= 1000 THEN 1 ELSE ceil((w - 1000) / 900.0) + 1 END""",
    "first_vectors": f"""SELECT model_name, len(embedding)::INTEGER AS dims, embedding[1]::DOUBLE AS first FROM {_NEW} WHERE source_path = (SELECT min(source_path) FROM translation_embeddings)
        QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY xml_id, chunk_index) = 1""",
    "missing_sources": f"SELECT {_KEY} FROM {_ALL} WHERE xml_id NOT IN (SELECT transcription_id FROM transcriptions WHERE language = 'en')",
    "vector_statistics": f"SELECT model_name, count(*) AS rows, min(len(embedding))::INTEGER AS min_dims, max(len(embedding))::INTEGER AS max_dims FROM {_ALL} GROUP BY model_name",
    "collection_dims": " UNION ALL ".join(f"""SELECT '{side}' AS side, model_name, count(*) AS documents, sum(n)::BIGINT AS chunks, count(*) FILTER (n > 1) AS chunked_documents, min(lo)::INTEGER AS min_dims, max(hi)::INTEGER AS max_dims
        FROM (SELECT model_name, tm_id, count(*) AS n, min(len(embedding)) AS lo, max(len(embedding)) AS hi FROM {rows} GROUP BY ALL) GROUP BY model_name""" for side, rows in (("transcriptions", _OLD), ("translations", _NEW))),
    "query_documents": f"SELECT model_name, tm_id, min(source_path) AS source_path, min(language) AS language, count(*) AS chunks FROM {_OLD} WHERE (model_name, tm_id) IN (SELECT (model_name, tm_id) FROM translation_embeddings) GROUP BY model_name, tm_id",
    "translation_ranks": _RANKS + " SELECT * FROM ranks",
    "nearest_translations": _RANKS + " SELECT model_name, tm_id, rank::INTEGER AS place, c AS near, round(distance, 6) AS distance FROM r JOIN d ON d.model_name = r.model_name AND d.q = r.tm_id AND d.c = r.c WHERE rank <= 5".replace("SELECT model_name, tm_id", "SELECT r.model_name, r.tm_id").replace("c AS near", "r.c AS near"),
    "retrieval_measures": _RANKS + """ SELECT model_name, CASE WHEN grouping(language_label) = 0 THEN 'language' WHEN grouping(chunk_group) = 0 THEN 'chunks' ELSE 'total' END AS slice_kind, coalesce(language_label, chunk_group, 'all') AS slice_value, count(*) AS queries,
        round(count(*) FILTER (rank <= 1) / count(*)::DOUBLE, 6) AS recall_1, round(count(*) FILTER (rank <= 5) / count(*)::DOUBLE, 6) AS recall_5, round(sum(coalesce(1.0::DOUBLE / rank, 0)) / count(*), 6) AS mrr
        FROM ranks GROUP BY GROUPING SETS ((model_name), (model_name, language_label), (model_name, chunk_group))""",
}
