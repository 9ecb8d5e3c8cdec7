"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.functions.languages import edition_language, language_code
from ostraka.llm import catalogue_sql, gazetteer, language, lookalike, mixing, names, neighbours, packing, splitting, tokens
from ostraka.session import cut
from ostraka.sources.tables import table


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    forms = cut(lookalike.lookalike_forms(table(spark, root, "transcriptions"), "transcription_id", ["text", "lemma_text"]))
    pairs = lookalike.lookalike_pairs(forms)
    return pairs.select("field_name", F.col("id_a").alias("transcription_id_a"), F.col("id_b").alias("transcription_id_b"))


def p1_classes(spark: SparkSession, root: str) -> DataFrame:
    """Every value with its class of values that look the same, and how many rows hold another string of it."""
    forms = cut(lookalike.lookalike_forms(table(spark, root, "transcriptions"), "transcription_id", ["text", "lemma_text"]))
    return lookalike.lookalike_classes(forms).withColumnRenamed("id", "transcription_id")


def p1_canonical(spark: SparkSession, root: str) -> DataFrame:
    """Both texts of every row in their one form."""
    t = table(spark, root, "transcriptions")
    return t.select("transcription_id", lookalike.canonical_text(F.col("text")).alias("text"), lookalike.canonical_text(F.col("lemma_text")).alias("lemma_text"))


SLICES = ("source", "language", "type")


def _slices() -> dict[str, Column]:
    tag = F.when(F.col("type") == "translation", F.col("language")).otherwise(edition_language(F.col("xml_content")))
    return {"source": F.substring_index("source_path", "/", 1), "language": F.coalesce(language_code(tag), F.lit("unknown")), "type": F.col("type")}


def _snapshot(spark: SparkSession, root: str) -> DataFrame:
    return tokens.measured(table(spark, root, "transcriptions"), "transcription_id", "text", _slices(), tokens.Ledger(spark))


def p2_tokens(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of every row, and in total of every slice and of all coarser ones.

    ``level`` is null in the lines of single rows; elsewhere it is the grouping id of the total. Every
    different text is encoded once; rows and totals are taken from the ledger's counts.
    """
    counted = cut(_snapshot(spark, root))
    rows = counted.select(F.lit(None).cast("int").alias("level"), F.col("key").alias("transcription_id"), *SLICES, F.lit(1).cast("bigint").alias("documents"), "tokens")
    totals = tokens.token_cube(tokens.finest_cells(counted, SLICES), SLICES).select("level", F.lit(None).cast("bigint").alias("transcription_id"), *SLICES, "documents", "tokens")
    return rows.unionByName(totals)


def p2_token_budget(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of every slice and of all coarser ones."""
    return tokens.token_cube(tokens.finest_cells(_snapshot(spark, root), SLICES), SLICES)


def p2_token_counts(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of every row."""
    return _snapshot(spark, root).select(F.col("key").alias("transcription_id"), F.lower(F.hex("content_hash")).alias("content_hash"), *SLICES, "tokens")


def _deliveries(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the corpus, measured with one ledger.

    The first has the translations and, of the editions lemmatised by then, the lemma texts. The second
    has the full texts of all rows but for those that repeat the text of a smaller id. So translations
    stay, lemmatised editions change, the others are added, and repeated texts are removed.
    """
    t, ledger = table(spark, root, "transcriptions"), tokens.Ledger(spark)
    first = t.withColumn("text", F.when(F.col("type") == "translation", F.col("text")).otherwise(F.col("lemma_text"))).filter("text is not null")
    least = t.groupBy(tokens.content_hash(F.col("text")).alias("own")).agg(F.min("transcription_id").alias("transcription_id")).select("transcription_id")
    second = t.join(least, "transcription_id", "left_semi")
    return tuple(cut(tokens.measured(d, "transcription_id", "text", _slices(), ledger)) for d in (first, second))


def p2_token_delta(spark: SparkSession, root: str) -> DataFrame:
    """Documents and tokens added, changed and removed between two states, by slice, with their signs."""
    changes = tokens.signed_changes(*_deliveries(spark, root), SLICES)
    return changes.groupBy("change", *SLICES).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def p2_token_refresh(spark: SparkSession, root: str) -> DataFrame:
    """The totals of the first state brought up to date by the signed changes to the second."""
    before, after = _deliveries(spark, root)
    delta = tokens.cube_delta(tokens.signed_changes(before, after, SLICES), SLICES)
    return tokens.token_cube(tokens.apply_delta(tokens.finest_cells(before, SLICES), delta, SLICES), SLICES)


def _vectors(spark: SparkSession, root: str) -> DataFrame:
    columns = ("model_name", "xml_id", "chunk_index", "embedding")
    return table(spark, root, "transcription_embeddings").select(*columns).unionByName(table(spark, root, "translation_embeddings").select(*columns))


#: Of 1, the exact search, to larger ones, which leave more out. README has the recall of this one.
FACTOR = 4.5


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    near = neighbours.similar_vectors(_vectors(spark, root), "model_name", ["xml_id", "chunk_index"], "embedding", 10, least=0.9, factor=FACTOR)
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pairs = near.select(F.col("grp").alias("model_name"), low.k0.alias("xml_id_a"), low.k1.alias("chunk_index_a"), high.k0.alias("xml_id_b"), high.k1.alias("chunk_index_b"))
    return pairs.distinct()


def p4_nearest(spark: SparkSession, root: str) -> DataFrame:
    """The 10 nearest of every vector whose xml_id is divisible by 50, among all."""
    near = neighbours.similar_vectors(_vectors(spark, root), "model_name", ["xml_id", "chunk_index"], "embedding", 10, factor=2.0, query=F.col("xml_id") % 50 == 0)
    return near.select(F.col("grp").alias("model_name"), F.col("a.k0").alias("xml_id"), F.col("a.k1").alias("chunk_index"), F.col("b.k0").alias("near_xml_id"), F.col("b.k1").alias("near_chunk_index"), F.round("similarity", 4).alias("similarity"))


CHUNK_KEY = ("xml_id", "model_name", "chunk_index")
LIMIT_WORDS, OVERLAP_WORDS = 500, 50


def _oversized(spark: SparkSession, root: str) -> DataFrame:
    """The oversized values, each key once; only they are shuffled."""
    return splitting.oversized(table(spark, root, "transcription_embeddings").select(*CHUNK_KEY, "document_text"), "document_text").dropDuplicates(list(CHUNK_KEY))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return splitting.split_oversized(_oversized(spark, root), "document_text", CHUNK_KEY).filter("piece_index = 0").select(*CHUNK_KEY)


def p5_pieces(spark: SparkSession, root: str) -> DataFrame:
    """Pieces of at most 500 words that overlap by 50."""
    return splitting.split_oversized(_oversized(spark, root), "document_text", CHUNK_KEY, LIMIT_WORDS, OVERLAP_WORDS)


def p5_restored(spark: SparkSession, root: str) -> DataFrame:
    """The words of every oversized value put together again from its pieces, and whether each piece keeps the limit."""
    pieces = p5_pieces(spark, root)
    words = F.filter(F.split("piece", splitting.SPLIT), lambda w: w != "")
    new = F.when(F.col("piece_index") == 0, words).otherwise(F.slice(words, OVERLAP_WORDS + 1, F.greatest(F.size(words) - OVERLAP_WORDS, F.lit(0))))
    whole = pieces.groupBy(*CHUNK_KEY).agg(F.array_sort(F.collect_list(F.struct("piece_index", new.alias("w")))).alias("p"), F.bool_and((F.col("words") <= LIMIT_WORDS) & (F.size(words) == F.col("words"))).alias("kept"))
    every = F.flatten(F.transform("p", lambda x: x["w"]))
    return whole.select(*CHUNK_KEY, F.size(every).alias("words"), F.sha2(F.array_join(every, " "), 256).alias("content_hash"), "kept")


def _unlinked_places(spark: SparkSession, root: str) -> DataFrame:
    geo = table(spark, root, "export_geo")
    rows = gazetteer.unlinked(table(spark, root, "orig_places"), "tm_place_id", geo)
    return gazetteer.map_places(rows, "place_id", "place_name", "full_place_name", gazetteer.entries_of(geo))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return _unlinked_places(spark, root).select("place_id", "geo_id")


def p6_unmatched(spark: SparkSession, root: str) -> DataFrame:
    """Names without an entry, with the rows that have them, the most frequent first."""
    none = _unlinked_places(spark, root).filter(F.col("geo_id") == gazetteer.NO_ENTRY).select("place_id")
    named = table(spark, root, "orig_places").select("place_id", "place_name", "full_place_name").join(none, "place_id")
    return named.groupBy("place_name", "full_place_name").agg(F.count(F.lit(1)).alias("rows"))


def p6_within(spark: SparkSession, root: str) -> DataFrame:
    """All entries within the distance of every different name of a place, with their edits."""
    return gazetteer.entries_within(table(spark, root, "orig_places"), "place_name", gazetteer.entries_of(table(spark, root, "export_geo")))


def _author_links(spark: SparkSession, root: str) -> DataFrame:
    modern = table(spark, root, "principal_editions").select("author", F.lit(False).alias("ancient"))
    ancient = table(spark, root, "ancient_editions").select("author", F.lit(True).alias("ancient"))
    return names.link_names(modern.unionByName(ancient))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return names.name_pairs(_author_links(spark, root))


def p7_entities(spark: SparkSession, root: str) -> DataFrame:
    """Every spelling with the entity that it means."""
    return _author_links(spark, root)


def _sizes(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of every document, by the ledger."""
    counted = tokens.measured(table(spark, root, "documents"), "doc_id", "text", {"source": F.col("source")}, tokens.Ledger(spark))
    return counted.select(F.col("key").alias("doc_id"), "source", "tokens")


def _runs(spark: SparkSession, root: str, items: int | None = None, cost: float | None = None) -> list[packing.Capacity]:
    """The runs of the fixed list; ``cost`` is a share of the attention cost of a container that one item fills."""
    rows = table(spark, root, "pack_runs").orderBy("run_name").collect()
    return [packing.Capacity(r["run_name"], r["capacity_tokens"], items, cost and cost * r["capacity_tokens"] ** 2) for r in rows]


#: Limits of p8_limited: documents of a container, and its attention cost as a share of the greatest.
LIMIT_ITEMS, LIMIT_COST = 4, 0.4


def p8_packed(spark: SparkSession, root: str) -> DataFrame:
    """The container of every document in every run."""
    return packing.pack(_sizes(spark, root), "doc_id", "tokens", _runs(spark, root))


def p8_limited(spark: SparkSession, root: str) -> DataFrame:
    """The same with few documents to a container and a bound on its attention cost."""
    return packing.pack(_sizes(spark, root), "doc_id", "tokens", _runs(spark, root, LIMIT_ITEMS, LIMIT_COST))


def _bins(packed: DataFrame) -> DataFrame:
    return packed.groupBy("run_name", "container").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("items"), F.sum(F.col("tokens") * F.col("tokens")).alias("cost"))


def p8_fill(spark: SparkSession, root: str) -> DataFrame:
    """Containers of every run and how full they are."""
    runs = table(spark, root, "pack_runs")
    return _bins(p8_packed(spark, root)).join(runs, "run_name").groupBy("run_name", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"),
        (F.sum("tokens") / F.sum("capacity_tokens")).alias("fill"), F.max("items").alias("most_items"),
    )


def p8_limits(spark: SparkSession, root: str) -> DataFrame:
    """What the limited packing holds: pieces, tokens, documents cut, and whether every limit holds and binds."""
    packed = cut(p8_limited(spark, root))
    whole = packed.groupBy("run_name").agg(F.count(F.lit(1)).alias("pieces"), F.sum("tokens").alias("tokens"), F.count_if(F.col("piece_index") == 1).alias("cut"))
    runs = table(spark, root, "pack_runs")
    alone, cost = F.col("items") == 1, F.lit(LIMIT_COST) * F.col("capacity_tokens") * F.col("capacity_tokens")
    held = (F.col("tokens") <= F.col("capacity_tokens")) & (F.col("items") <= LIMIT_ITEMS) & (alone | (F.col("cost") <= cost))
    limits = _bins(packed).join(runs, "run_name").groupBy("run_name").agg(F.bool_and(held).alias("held"), F.bool_or(F.col("items") == LIMIT_ITEMS).alias("items_bind"))
    return whole.join(limits, "run_name")


def _targets(spark: SparkSession, root: str) -> list[mixing.Target]:
    return [mixing.Target(r["mix_name"], r["source"], r["target_share"], r["max_repeats"]) for r in table(spark, root, "mix_targets").orderBy("mix_name", "source").collect()]


def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    """The documents of every mix with their copies."""
    return mixing.mix_sources(_sizes(spark, root), "doc_id", "source", "tokens", _targets(spark, root))


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    """The shares that every mix reached."""
    return mixing.reached_shares(p9_mix(spark, root), "doc_id", _targets(spark, root))


def p9_held(spark: SparkSession, root: str) -> DataFrame:
    """Every target of every mix, whether its share is reached to half a hundredth and its cap is kept."""
    shares = p9_shares(spark, root)
    return shares.select("mix_name", "source", "target_share", "max_repeats", (F.abs(F.col("share") - F.col("target_share")) < 0.005).alias("reached"), (F.col("most_copies") <= F.col("max_repeats")).alias("kept"))


def _languages(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents")
    model = language.fit(d, "doc_id", "text", "lang")
    return language.document_languages(language.language_segments(d, ["doc_id", "lang"], "text", model), ["doc_id", "lang"])


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return language.doubtful_labels(_languages(spark, root), ["doc_id", "lang"], "lang").select("doc_id", "lang_code")


def p10_segments(spark: SparkSession, root: str) -> DataFrame:
    """Every stretch of one language with its confidence."""
    d = table(spark, root, "documents")
    return language.language_segments(d, ["doc_id"], "text", language.fit(d, "doc_id", "text", "lang"))


def p10_documents(spark: SparkSession, root: str) -> DataFrame:
    """The main language of every document with its confidence, and how many languages it has."""
    every = _languages(spark, root).groupBy("doc_id", "lang").agg(
        F.max(F.when(F.col("main"), F.col("lang_code"))).alias("lang_code"),
        F.max(F.when(F.col("main"), F.col("confidence"))).alias("confidence"),
        F.count(F.lit(1)).cast("int").alias("languages"),
    )
    return every.select("doc_id", F.col("lang").alias("label"), "lang_code", "confidence", "languages")


QUERIES = {
    "p1_found": p1_found,
    "p1_classes": p1_classes,
    "p1_canonical": p1_canonical,
    "p2_tokens": p2_tokens,
    "p2_token_counts": p2_token_counts,
    "p2_token_budget": p2_token_budget,
    "p2_token_delta": p2_token_delta,
    "p2_token_refresh": p2_token_refresh,
    "p4_found": p4_found,
    "p4_nearest": p4_nearest,
    "p5_found": p5_found,
    "p5_pieces": p5_pieces,
    "p5_restored": p5_restored,
    "p6_found": p6_found,
    "p6_unmatched": p6_unmatched,
    "p6_within": p6_within,
    "p7_found": p7_found,
    "p7_entities": p7_entities,
    "p8_packed": p8_packed,
    "p8_limited": p8_limited,
    "p8_fill": p8_fill,
    "p8_limits": p8_limits,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p9_held": p9_held,
    "p10_found": p10_found,
    "p10_segments": p10_segments,
    "p10_documents": p10_documents,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(catalogue_sql.SQL)
