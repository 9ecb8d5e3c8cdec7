"""Tables written and read back: exchange files, versions, refreshed vectors, manifests, bibliography records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.functions import languages
from ostraka.operators import biblio, embeddings, images
from ostraka.plans.retrieval import BLANKS, SPLIT
from ostraka.plans.texts import edition_language_sql, element_of
from ostraka.session import scratch
from ostraka.sources import dumps, manifests
from ostraka.sources.tables import table
from ostraka.sources.warehouse import Warehouse, term_vector
from ostraka.streaming.refresh import refresh_stream

MODEL = "lumen-embed-small"


def csv_round_trip(spark: SparkSession, root: str) -> DataFrame:
    """Places dumped as CSV, in order, and read back by their schema."""
    rows, target = table(spark, root, "orig_places"), scratch(spark, "csv")
    dumps.dump_csv(rows, target, rows.columns, ["place_id"])
    return dumps.read_csv(spark, target, rows.schema)


def gazetteer_from_csv(spark: SparkSession, root: str) -> DataFrame:
    """The list of places as CSV with semicolons at the ends of lines, and read back without them."""
    rows, target = table(spark, root, "export_geo"), scratch(spark, "geo")
    last = F.concat(F.coalesce(F.col("coordinates"), F.lit("")), F.lit(";;")).alias("coordinates;;")
    names = dumps.GAZETTEER.fieldNames()
    dumps.dump_csv(rows.select(*names[:-1], last), target, [*names[:-1], "coordinates;;"], ["id"])
    return dumps.read_gazetteer(spark, target)


def copied_tables(spark: SparkSession, root: str) -> DataFrame:
    target = scratch(spark, "copy")
    dumps.copy_tables(spark, root, target, ["papyri", "mix_targets"])
    return table(spark, target, "papyri").select("source_path", "tm_id", "title")


def imported_model(spark: SparkSession, root: str) -> DataFrame:
    """A model's vectors of translations dumped and put in place of those of transcriptions, in a store of versions."""
    store, target = Warehouse(spark, scratch(spark, "store")), scratch(spark, "dump")
    for name in ("transcription_embeddings", "translation_embeddings"):
        rows = embeddings.deduplicated(table(spark, root, name))
        for model in sorted(r["model_name"] for r in rows.select("model_name").distinct().collect()):
            store.write(name, rows.filter(F.col("model_name") == model), embeddings.KEY, model)
    store.dump_model(target, MODEL, "translation")
    store.import_model(target, MODEL, "transcription")
    return store.read("transcription_embeddings").select(*embeddings.KEY, "input_hash")


def without_a_model(spark: SparkSession, root: str) -> DataFrame:
    """What is left in a store of versions when a model is deleted."""
    store = Warehouse(spark, scratch(spark, "store"))
    rows = embeddings.deduplicated(table(spark, root, "translation_embeddings"))
    for model in sorted(r["model_name"] for r in rows.select("model_name").distinct().collect()):
        store.write("translation_embeddings", rows.filter(F.col("model_name") == model), embeddings.KEY, model)
    store.delete_model(MODEL)
    return store.read("translation_embeddings").select(*embeddings.KEY, "input_hash")


def _skipping(texts: list[str]) -> list:
    """A stand-in that finds texts of more than 6,000 characters too long."""
    return [None if len(t) > 6000 else v for t, v in zip(texts, embeddings.hash_embedder(8)(texts))]


def _refresh(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    stored = embeddings.deduplicated(table(spark, root, "translation_embeddings"))
    documents = table(spark, root, "transcriptions").filter("type = 'translation'")
    chunks = embeddings.document_chunks(documents, MODEL, F.col("language"))
    return embeddings.refreshed(stored, chunks, MODEL, _skipping)


def refreshed_vectors(spark: SparkSession, root: str) -> DataFrame:
    """The vectors of translations after a refresh of one model: its rows follow the texts, the others stay."""
    return _refresh(spark, root)[0].select(*embeddings.KEY, "input_hash", F.size("embedding").alias("dims"))


def skipped_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Chunks that a refresh embedded, and those that the model found too long."""
    return _refresh(spark, root)[1].select(*embeddings.KEY, "skipped")


def streamed_vectors(spark: SparkSession, root: str) -> DataFrame:
    """An empty table of vectors filled from a stream of all documents."""
    source = table(spark, root, "transcriptions")
    target, checkpoint = scratch(spark, "streamed"), scratch(spark, "progress")
    store = Warehouse(spark, target)
    stored = table(spark, root, "translation_embeddings").limit(0).schema
    stream = spark.readStream.schema(source.schema).parquet(f"{root.rstrip('/')}/transcriptions.parque*")
    query = refresh_stream(stream, lambda s: store.read("vectors", stored), lambda rows, _: store.write("vectors", rows), MODEL, embeddings.hash_embedder(4), checkpoint)
    query.awaitTermination()
    return store.read("vectors", stored).select(*embeddings.KEY, "input_hash", F.size("embedding").alias("dims"))


def vector_literals(spark: SparkSession, root: str) -> DataFrame:
    """Vectors written as text and read back."""
    rows = embeddings.deduplicated(table(spark, root, "translation_embeddings"))
    literal = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ","), F.lit("]"))
    parsed = embeddings.parsed_vector(literal)
    return rows.select(*embeddings.KEY, F.size(parsed).alias("dims"), F.round(F.aggregate(parsed, F.lit(0.0), lambda a, x: a + x), 4).alias("sum"))


def term_vectors(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "transcriptions").select("transcription_id", term_vector(F.col("lemma_text")).alias("vector"))


def edition_languages(spark: SparkSession, root: str) -> DataFrame:
    """The one code for whatever spelling of a language a text is tagged with."""
    tag = F.when(F.col("type") == "translation", F.col("language")).otherwise(languages.edition_language(F.col("xml_content")))
    return table(spark, root, "transcriptions").select("transcription_id", languages.language_code(tag).alias("code"))


# images


def _entries(spark: SparkSession, root: str) -> DataFrame:
    """An entry for each metadata file: one image for each of its catalogue numbers."""
    p = table(spark, root, "papyri")
    file = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.concat(F.lit(f"{c}/"), F.col(c).cast("string")).alias("path"), F.length(F.col(c).cast("string")).cast("bigint").alias("size"), F.sha2(F.col(c).cast("string"), 256).alias("sha256")))
    return p.select(
        F.col("tm_id").cast("string").alias("directory"), F.concat(F.lit("https://example.org/"), F.col("source_path")).alias("source_url"), F.col("title").alias("effective_url"), F.lit("Site").alias("scraper"),
        F.array(F.col("tm_id").cast("string")).alias("source_ids"), F.lit("2020-01-01").alias("scraped_at"), F.array_compact(F.array(file("hgv_id"), file("ldab_id"))).alias("files"),
    )


def manifest_round_trip(spark: SparkSession, root: str) -> DataFrame:
    """Manifests written, one for each record, and read back."""
    target = scratch(spark, "manifests")
    manifests.write_manifests(_entries(spark, root), target)
    found = manifests.read_manifests(spark, f"{target}/directory=*/*.json")
    return found.select(F.regexp_extract("directory", "directory=(.*)$", 1).alias("tm_id"), "source_url", "effective_url", F.size("files").alias("files"), F.array_join(F.transform("files", lambda f: f["path"]), " ").alias("paths"))


def complete_images(spark: SparkSession, root: str) -> DataFrame:
    """Entries all of whose files are there as recorded; the files of LDAB numbers that end in 7 are missing."""
    entries = _entries(spark, root)
    files = entries.select(F.explode("files").alias("f")).select("f.*").filter("not (path like 'ldab_id/%7')").distinct()
    return images.complete_entries(entries, files)


def merged_entries(spark: SparkSession, root: str) -> DataFrame:
    """Entries of an earlier run, joined by those of a later one for records with an MP3 number."""
    names = ("source_url", "effective_url", "scraper", "scraped_at", "source_ids", "files")
    old = _entries(spark, root).select(*names)
    later = table(spark, root, "papyri").filter("mp3_id is not null").select(F.concat(F.lit("https://example.org/"), F.col("source_path")).alias("source_url"), "mp3_id")
    file = F.struct(F.concat(F.lit("new/"), F.col("mp3_id")).alias("path"), F.lit(1).cast("bigint").alias("size"), F.lit("h").alias("sha256"))
    new = later.select("source_url", F.lit("e").alias("effective_url"), F.lit("Later").alias("scraper"), F.lit("2021-01-01").alias("scraped_at"), F.array(F.lit("x")).alias("source_ids"), F.array(file).alias("files"))
    merged = images.merged_manifests(old, new)
    return merged.select("source_url", "effective_url", "scraper", "scraped_at", F.array_join("source_ids", " ").alias("ids"), F.coalesce(F.size("files"), F.lit(0)).alias("files"))


def resolved_links(spark: SparkSession, root: str) -> DataFrame:
    """Addresses that lead on by one or two steps, round in a circle, or nowhere, by their numbers."""
    ids = table(spark, root, "papyri").select("tm_id").distinct()
    step = lambda a, b, where: ids.filter(where).select(F.concat(F.lit(a), F.col("tm_id").cast("string")).alias("url"), F.concat(F.lit(b), F.col("tm_id").cast("string")).alias("target"))
    nowhere = ids.filter("tm_id % 5 = 4").select(F.concat(F.lit("c"), F.col("tm_id").cast("string")).alias("url"), F.lit("").alias("target"))
    redirects = step("a", "b", "tm_id % 2 = 0").unionByName(step("b", "c", "tm_id % 3 = 0")).unionByName(step("c", "a", "tm_id % 5 = 3")).unionByName(nowhere)
    return images.resolved_links(ids.select(F.concat(F.lit("a"), F.col("tm_id").cast("string")).alias("url")), redirects)


def outcome_table(spark: SparkSession, root: str) -> DataFrame:
    """Outcomes of links by handler as a table with a column for each."""
    p = table(spark, root, "papyri")
    outcome = F.element_at(F.array(*[F.lit(o) for o in images.OUTCOMES]), (F.col("tm_id") % len(images.OUTCOMES) + 1).cast("int"))
    return images.outcome_counts(p.select(F.coalesce("material", F.lit("none")).alias("handler"), outcome.alias("outcome")))


def broken_list(spark: SparkSession, root: str) -> DataFrame:
    """Lines of a list of broken links: comments and blank lines don't count, repeated ones once."""
    p = table(spark, root, "papyri")
    line = F.when(F.col("tm_id") % 3 == 0, F.concat(F.lit("# "), F.col("source_path"))).when(F.col("tm_id") % 3 == 1, F.concat(F.lit(" "), F.col("tm_id").cast("string"), F.lit(": u "))).otherwise("  ")
    return images.broken_entries(p.select(line.alias("value")))


# bibliography


def _bibl(spark: SparkSession, root: str) -> DataFrame:
    """Editions as records of a bibliography that point at one another."""
    pointer = F.concat(F.lit('<relatedItem type="reviews"><bibl><ptr target="https://papyri.info/biblio/'), F.col("biblio_id").cast("string"), F.lit('"/></bibl></relatedItem>'))
    named = F.when(F.col("author").contains(" "), F.concat(F.lit("<author><surname>"), F.regexp_replace(element_of("x", F.col("author")), "^<x>|</x>$", ""), F.lit("</surname><forename>A</forename></author>"))).otherwise(element_of("author", F.col("author")))
    parts = [
        F.lit('<bibl xml:id="b'), F.col("principal_edition_id").cast("string"), F.lit('" type="book"><idno type="pi">'), F.col("principal_edition_id").cast("string"), F.lit("</idno>"), element_of("title", F.col("title"), ' level="m" type="main"'), F.coalesce(named, F.lit("")),
        F.lit("<date>ca. "), (F.lit(1800) + F.col("principal_edition_id") % 200).cast("string"), F.lit("</date>"), element_of("biblScope", F.col("page"), ' unit="pp"'), F.coalesce(pointer, F.lit("")), F.lit("</bibl>"),
    ]
    path = F.concat(F.lit("Biblio/"), F.col("principal_edition_id").cast("string"), F.lit(".xml"))
    return table(spark, root, "principal_editions").select(path.alias("source_path"), F.concat(*parts).alias("xml"))


def biblio_fact_counts(spark: SparkSession, root: str) -> DataFrame:
    return biblio.fact_counts(biblio.biblio_facts(_bibl(spark, root)))


def biblio_relations(spark: SparkSession, root: str) -> DataFrame:
    return biblio.relation_edges(biblio.biblio_facts(_bibl(spark, root)))


def biblio_top_targets(spark: SparkSession, root: str) -> DataFrame:
    """The thirty records most pointed to: the limit is what it is for."""
    return biblio.top_targets(biblio.relation_edges(biblio.biblio_facts(_bibl(spark, root))))


def biblio_pointers(spark: SparkSession, root: str) -> DataFrame:
    return biblio.metadata_pointers(_bibl(spark, root))


QUERIES = {f.__name__: f for f in (
    csv_round_trip, gazetteer_from_csv, copied_tables, imported_model, without_a_model, refreshed_vectors, skipped_chunks, streamed_vectors, vector_literals, term_vectors, edition_languages,
    manifest_round_trip, complete_images, merged_entries, resolved_links, outcome_table, broken_list, biblio_fact_counts, biblio_relations, biblio_top_targets, biblio_pointers,
)}
_DEDUP = "(SELECT * FROM {} QUALIFY row_number() OVER (PARTITION BY xml_id, model_name, chunk_index ORDER BY updated_at DESC, input_hash, embedding) = 1)"
_OLD, _NEW = _DEDUP.format("transcription_embeddings"), _DEDUP.format("translation_embeddings")
_KEY = "xml_id, model_name, chunk_index"


def _chunks_sql(where: str) -> str:
    """Chunks of 500 words of the texts, each a tenth over the one before."""
    return f"""w AS (SELECT transcription_id AS xml_id, text, list_filter(regexp_split_to_array(text, '{BLANKS}'), lambda x: x <> '') AS w FROM transcriptions WHERE {where} AND regexp_replace(text, '{BLANKS}', '', 'g') <> ''),
s AS (SELECT *, unnest(CASE WHEN len(w) <= 500 THEN [0] ELSE range(0, ceil((len(w) - 500) / 450.0)::BIGINT + 1) END)::INTEGER AS chunk_index FROM w),
k AS (SELECT xml_id, '{MODEL}' AS model_name, chunk_index, CASE WHEN len(w) <= 500 THEN text ELSE array_to_string(w[chunk_index * 450 + 1:chunk_index * 450 + 500], ' ') END AS chunk FROM s)"""


_KEPT = f"""o AS {_NEW}, c AS (SELECT k.*, sha256(chunk) AS input_hash, o.input_hash AS old_hash, len(o.embedding)::INTEGER AS old_dims, t.source_path IS NOT DISTINCT FROM o.source_path AND t.tm_id::VARCHAR IS NOT DISTINCT FROM o.tm_id AND t.language IS NOT DISTINCT FROM o.language AND o.xml_id IS NOT NULL AS known
  FROM k JOIN transcriptions t ON t.transcription_id = k.xml_id LEFT JOIN o USING (xml_id, model_name, chunk_index))"""
_TOO_LONG = "length(chunk) > 6000"
_ENTRIES = """SELECT tm_id::VARCHAR AS tm_id, 'https://example.org/' || source_path AS source_url, title AS effective_url, mp3_id, ldab_id, list_filter([CASE WHEN hgv_id IS NOT NULL THEN 'hgv_id/' || hgv_id END, CASE WHEN ldab_id IS NOT NULL THEN 'ldab_id/' || ldab_id END], lambda x: x IS NOT NULL) AS paths FROM papyri"""
_ID = "principal_edition_id::VARCHAR"
_AUTHOR = r"nullif(trim(regexp_replace(author, '[ \t\r\n]+', ' ', 'g')), '')"
SQL = {
    "csv_round_trip": "SELECT * FROM orig_places",
    "gazetteer_from_csv": "SELECT id, begin_date, end_date, " + ", ".join(f"nullif(trim(regexp_replace({c}::VARCHAR, ';+$', '')), '') AS {c}" for c in dumps.GAZETTEER.fieldNames() if c not in ("id", "begin_date", "end_date")) + " FROM export_geo",
    "copied_tables": "SELECT source_path, tm_id, title FROM papyri",
    "imported_model": f"SELECT {_KEY}, input_hash FROM {_OLD} WHERE model_name <> '{MODEL}' UNION ALL SELECT {_KEY}, input_hash FROM {_NEW} WHERE model_name = '{MODEL}'",
    "without_a_model": f"SELECT {_KEY}, input_hash FROM {_NEW} WHERE model_name <> '{MODEL}'",
    # an unchanged chunk keeps its row; a changed one is embedded anew unless it is too long, and then keeps what it had
    "refreshed_vectors": f"""WITH {_chunks_sql("type = 'translation'")}, {_KEPT} SELECT {_KEY}, input_hash, len(embedding)::INTEGER AS dims FROM o WHERE model_name <> '{MODEL}'
        UNION ALL SELECT {_KEY}, CASE WHEN known AND input_hash = old_hash OR {_TOO_LONG} THEN old_hash ELSE input_hash END, CASE WHEN known AND input_hash = old_hash OR {_TOO_LONG} THEN old_dims ELSE 8 END FROM c WHERE NOT ({_TOO_LONG} AND old_hash IS NULL)""",
    "skipped_chunks": f"WITH {_chunks_sql(chr(39).join(('type = ', 'translation', '')))}, {_KEPT} SELECT {_KEY}, {_TOO_LONG} AS skipped FROM c WHERE NOT (known AND input_hash IS NOT DISTINCT FROM old_hash)",
    "streamed_vectors": f"WITH {_chunks_sql('true')} SELECT {_KEY}, sha256(chunk) AS input_hash, 4 AS dims FROM k",
    "vector_literals": f"SELECT {_KEY}, len(embedding)::INTEGER AS dims, round(list_sum(embedding::DOUBLE[]), 4) AS sum FROM {_NEW}",
    "term_vectors": f"""WITH w AS (SELECT transcription_id, list_filter(regexp_split_to_array(lower(lemma_text), {SPLIT}), lambda x: x <> '') AS w FROM transcriptions WHERE lemma_text IS NOT NULL),
        p AS (SELECT transcription_id, x, string_agg(i::VARCHAR, ',' ORDER BY i) AS places FROM (SELECT transcription_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w) GROUP BY ALL),
        v AS (SELECT transcription_id, string_agg('''' || x || ''':' || places, ' ' ORDER BY x) AS vector FROM p GROUP BY transcription_id)
        SELECT t.transcription_id, CASE WHEN lemma_text IS NOT NULL THEN coalesce(vector, '') END AS vector FROM transcriptions t LEFT JOIN v USING (transcription_id)""",
    "edition_languages": f"""SELECT transcription_id, CASE split_part(replace(lower(trim(CASE WHEN type = 'translation' THEN language ELSE {edition_language_sql('xml_content')} END)), '_', '-'), '-', 1) WHEN 'en' THEN 'en' WHEN 'eng' THEN 'en' WHEN 'english' THEN 'en' WHEN 'de' THEN 'de' WHEN 'deu' THEN 'de'
        WHEN 'ger' THEN 'de' WHEN 'german' THEN 'de' WHEN 'deutsch' THEN 'de' WHEN 'fr' THEN 'fr' WHEN 'fra' THEN 'fr' WHEN 'fre' THEN 'fr' WHEN 'french' THEN 'fr' WHEN 'francais' THEN 'fr' WHEN 'français' THEN 'fr' WHEN 'it' THEN 'it' WHEN 'ita' THEN 'it' WHEN 'italian' THEN 'it' WHEN 'italiano' THEN 'it'
        WHEN 'es' THEN 'es' WHEN 'spa' THEN 'es' WHEN 'spanish' THEN 'es' WHEN 'espanol' THEN 'es' WHEN 'español' THEN 'es' WHEN 'la' THEN 'la' WHEN 'lat' THEN 'la' WHEN 'latin' THEN 'la' WHEN 'grc' THEN 'grc' WHEN 'el' THEN 'grc' WHEN 'ell' THEN 'grc' WHEN 'gre' THEN 'grc' WHEN 'greek' THEN 'grc'
        WHEN 'cop' THEN 'cop' WHEN 'coptic' THEN 'cop' END AS code FROM transcriptions""",
    "manifest_round_trip": f"SELECT tm_id, source_url, effective_url, len(paths)::INTEGER AS files, array_to_string(paths, ' ') AS paths FROM ({_ENTRIES})",
    "complete_images": f"SELECT DISTINCT source_url, effective_url FROM ({_ENTRIES}) GROUP BY ALL HAVING sum(len(paths)) > 0 AND bool_and(ldab_id IS NULL OR ldab_id::VARCHAR NOT LIKE '%7')",
    "merged_entries": f"""SELECT source_url, CASE WHEN mp3_id IS NULL THEN effective_url ELSE 'e' END AS effective_url, CASE WHEN mp3_id IS NULL THEN 'Site' ELSE 'Later' END AS scraper, CASE WHEN mp3_id IS NULL THEN '2020-01-01' ELSE '2021-01-01' END AS scraped_at,
        CASE WHEN mp3_id IS NULL THEN tm_id ELSE tm_id || ' x' END AS ids, (len(paths) + CASE WHEN mp3_id IS NULL THEN 0 ELSE 1 END)::INTEGER AS files FROM ({_ENTRIES})""",
    "resolved_links": """WITH i AS (SELECT DISTINCT tm_id AS n FROM papyri), f AS (SELECT n, n % 2 = 0 AS one, n % 2 = 0 AND n % 3 = 0 AS two FROM i)
        SELECT 'a' || n AS url, CASE WHEN two THEN 'c' || n WHEN one THEN 'b' || n ELSE 'a' || n END AS effective_url, CASE WHEN two AND n % 5 = 3 THEN 'cycle' WHEN two AND n % 5 = 4 THEN 'empty' ELSE 'ok' END AS status FROM f""",
    "outcome_table": "SELECT coalesce(material, 'none') AS handler, " + ", ".join(f"count(*) FILTER (tm_id % {len(images.OUTCOMES)} = {i}) AS {o}" for i, o in enumerate(images.OUTCOMES)) + " FROM papyri GROUP BY 1",
    "broken_list": "SELECT DISTINCT tm_id::VARCHAR || ': u' AS entry FROM papyri WHERE tm_id % 3 = 1",
    "biblio_fact_counts": f"""WITH f AS (SELECT {_ID} AS i, 'identity' AS kind, 'consistent' AS value FROM principal_editions UNION ALL SELECT {_ID}, 'type', 'book' FROM principal_editions UNION ALL SELECT {_ID}, 'idno', 'pi' FROM principal_editions
        UNION ALL SELECT {_ID}, 'title', 'level=m, type=main' FROM principal_editions WHERE title IS NOT NULL
        UNION ALL SELECT {_ID}, 'contributor', CASE WHEN contains(author, ' ') THEN 'author:surname + forename' WHEN {_AUTHOR} IS NULL THEN 'author:empty' ELSE 'author:text' END FROM principal_editions WHERE author IS NOT NULL
        UNION ALL SELECT {_ID}, 'date', (1800 + principal_edition_id % 200)::VARCHAR FROM principal_editions UNION ALL SELECT {_ID}, 'scope', 'pp' FROM principal_editions WHERE page IS NOT NULL UNION ALL SELECT {_ID}, 'relation', 'reviews' FROM principal_editions WHERE biblio_id IS NOT NULL)
        SELECT kind, value, count(DISTINCT i) AS records, count(*) AS occurrences FROM f GROUP BY ALL""",
    "biblio_relations": f"SELECT {_ID} AS source, 'reviews' AS relation, biblio_id::VARCHAR AS target, 1::BIGINT AS times FROM principal_editions WHERE biblio_id IS NOT NULL",
    "biblio_top_targets": "SELECT 'reviews' AS relation, biblio_id::VARCHAR AS target, count(*) AS times, row_number() OVER (ORDER BY count(*) DESC, biblio_id::VARCHAR)::INTEGER AS place FROM principal_editions WHERE biblio_id IS NOT NULL GROUP BY biblio_id QUALIFY place <= 30",
    "biblio_pointers": f"SELECT 'Biblio/' || {_ID} || '.xml' AS source_path, biblio_id::VARCHAR AS biblio_id, 'bibl' AS place FROM principal_editions WHERE biblio_id IS NOT NULL",
}
