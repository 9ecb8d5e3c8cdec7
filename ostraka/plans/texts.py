"""Rendering, languages, records and metadata on the corpus tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.functions import languages, text
from ostraka.operators import lemmas, metadata, render
from ostraka.plans.retrieval import BLANKS
from ostraka.sources import corpus
from ostraka.sources.tables import table


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "transcriptions")


def render_text(spark: SparkSession, root: str) -> DataFrame:
    """Every text rendered anew; null where the XML is cut off."""
    return _documents(spark, root).select("transcription_id", render.render_document(F.col("xml_content"), F.col("type")).alias("rendered"))


def render_diplomatic(spark: SparkSession, root: str) -> DataFrame:
    """Editions without expansions, lost and unclear text, broken at gaps."""
    shown = render.render_edition(F.col("xml_content"), render.Switches(break_on_gap=True))
    return _documents(spark, root).filter("type = 'transcription'").select("transcription_id", shown.alias("rendered"))


def document_languages(spark: SparkSession, root: str) -> DataFrame:
    """The language that each document says it is in, read from its XML."""
    d = _documents(spark, root)
    return d.select("transcription_id", render.document_language(F.col("xml_content")).alias("xml_language"), languages.edition_language(F.col("xml_content")).alias("tag_language"))


def snippet_hashes(spark: SparkSession, root: str) -> DataFrame:
    d = _documents(spark, root)
    return d.select("transcription_id", F.sha2(render.snippet(F.col("xml_content")), 256).alias("edition"), F.size(render.snippets(F.col("xml_content"))).alias("translations"))


def sentence_chunks(spark: SparkSession, root: str) -> DataFrame:
    return _documents(spark, root).select("transcription_id", F.posexplode(text.sentence_chunks(F.col("text"))).alias("chunk_index", "chunk"))


def lemmatized_texts(spark: SparkSession, root: str) -> DataFrame:
    tag = F.coalesce("language", languages.edition_language(F.col("xml_content")))
    return lemmas.lemmatized(_documents(spark, root), tag).select("transcription_id", "lemma_text")


def language_names(spark: SparkSession, root: str) -> DataFrame:
    tag = F.col("language")
    return _documents(spark, root).select("transcription_id", text.language_label(tag).alias("label"), text.normalize_language(F.coalesce(tag, F.lit("el-Grek"))).alias("lemma_language"))


def token_estimates(spark: SparkSession, root: str) -> DataFrame:
    d = _documents(spark, root)
    return d.groupBy("type", text.text_length_bucket(F.col("text")).alias("bucket")).agg(F.count(F.lit(1)).alias("documents"), F.sum(text.estimated_tokens(F.col("text"))).alias("tokens"))


def partition_names(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "papyri")
    return p.select("source_path", text.partition_name(F.col("tm_id").cast("string")).alias("partition"), corpus.stem(F.col("source_path")).alias("stem"))


def translation_groups(spark: SparkSession, root: str) -> DataFrame:
    paths = _documents(spark, root).filter("type = 'translation'").select("source_path").distinct()
    return corpus.translation_groups(paths).select("hgv_id", F.array_join("translation_paths", " ").alias("paths"))


def record_assembly(spark: SparkSession, root: str) -> DataFrame:
    """Metadata files with the transcription and the translations that belong to them by name."""
    d = _documents(spark, root)
    own = d.filter("type = 'transcription'").select("source_path").distinct().withColumn("has_edition", F.lit(True))
    other = d.filter("type = 'translation'").select("source_path").distinct()
    meta = table(spark, root, "papyri").select(F.col("tm_id").cast("string").alias("tm_id"), "source_path")
    found = corpus.associate(meta, own, other)
    return found.select("tm_id", "metadata_path", "transcription_path", F.array_join("translation_paths", " ").alias("translations"))


def element_of(name: str, value: Column, attributes: str = "") -> Column:
    escaped = F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.coalesce(F.concat(F.lit(f"<{name}{attributes}>"), escaped, F.lit(f"</{name}>")), F.lit(""))


PAPYRI = {"dclp_hybrid_id": "dclp-hybrid", "ddb_filename": "ddb-filename", "ddb_hybrid_id": "ddb-hybrid", "hgv_id": "HGV", "ldab_id": "LDAB", "mp3_id": "MP3"}


def papyri_xml(spark: SparkSession, root: str) -> DataFrame:
    """The rows of papyri as records in XML."""
    ids = [element_of("idno", F.col("tm_id").cast("string"), ' type="TM"')] + [element_of("idno", F.col(c), f' type="{k}"') for c, k in PAPYRI.items()]
    parts = [
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt>'), element_of("title", F.col("title")), F.lit("</titleStmt><publicationStmt>"), *ids,
        F.lit("</publicationStmt><sourceDesc><msDesc><msIdentifier>"), element_of("collection", F.col("current_location")),
        F.lit("</msIdentifier><physDesc><objectDesc><supportDesc><support>"), element_of("material", F.col("material")), F.lit("</support></supportDesc></objectDesc></physDesc></msDesc></sourceDesc></fileDesc></teiHeader></TEI>"),
    ]
    return table(spark, root, "papyri").select("source_path", F.concat(*parts).alias("xml"))


def metadata_papyri(spark: SparkSession, root: str) -> DataFrame:
    parsed = metadata.extracted(papyri_xml(spark, root))
    return metadata.metadata_table(parsed, "papyri").select("source_path", "tm_id", *PAPYRI, "title", "material", "current_location")


def _editions_xml(spark: SparkSession, root: str) -> DataFrame:
    """The rows of principal_editions as records in XML, one edition each."""
    target = F.concat(F.lit('<ptr target="https://papyri.info/biblio/'), F.col("biblio_id").cast("string"), F.lit('"/>'))
    scopes = [element_of("biblScope", F.col(c), f' unit="{c}"') for c in ("volume", "number", "page")]
    parts = [
        F.lit("<TEI><teiHeader><fileDesc><publicationStmt>"), element_of("idno", F.col("tm_id").cast("string"), ' type="TM"'),
        F.lit('</publicationStmt></fileDesc></teiHeader><text><body><div type="bibliography" subtype="principalEdition"><listBibl><bibl>'),
        element_of("title", F.col("title"), ' type="abbreviated"'), F.coalesce(target, F.lit("")), element_of("author", F.col("author")), *scopes, F.lit("</bibl></listBibl></div></body></text></TEI>"),
    ]
    return table(spark, root, "principal_editions").select(F.lpad(F.col("principal_edition_id").cast("string"), 9, "0").alias("source_path"), F.concat(*parts).alias("xml"))


def metadata_editions(spark: SparkSession, root: str) -> DataFrame:
    """Editions read back from XML, numbered in record order."""
    return metadata.metadata_table(metadata.extracted(_editions_xml(spark, root)), "principal_editions")


def _record(spark: SparkSession, root: str, name: str, key: str, header: list[Column], body: list[Column]) -> DataFrame:
    """Rows of a table as records in XML, numbered by the key in their paths."""
    tm = element_of("idno", F.col("tm_id").cast("string"), ' type="TM"')
    parts = [F.lit("<TEI><teiHeader><fileDesc><publicationStmt>"), tm, F.lit("</publicationStmt></fileDesc>"), *header, F.lit("</teiHeader><text><body>"), *body, F.lit("</body></text></TEI>")]
    return table(spark, root, name).select(F.lpad(F.col(key).cast("string"), 9, "0").alias("source_path"), F.concat(*parts).alias("xml"))


def keyword_values(spark: SparkSession, root: str) -> DataFrame:
    """Place names written as keywords and read back: marks of doubt apart."""
    terms = [F.lit('<profileDesc><textClass><keywords scheme="hgv">'), element_of("term", F.col("place_name"), ' type="place"'), F.lit("</keywords></textClass></profileDesc>")]
    return metadata.metadata_table(metadata.extracted(_record(spark, root, "orig_places", "place_id", terms, [])), "keywords")


def metadata_places(spark: SparkSession, root: str) -> DataFrame:
    """Places written as provenances, with a second reference and a place of another kind, and read back."""
    reference = F.concat_ws(" ", F.concat(F.lit("https://www.trismegistos.org/place/"), F.col("tm_place_id").cast("string")), F.concat(F.lit("https://www.trismegistos.org/place/"), F.col("tm_id").cast("string")), F.concat(F.lit("https://pleiades.stoa.org/places/"), F.col("pleiades_place_id").cast("string")))
    start = F.concat(F.lit('<placeName type="ancient" subtype="'), F.col("granularity"), F.lit('" ref="'), reference, F.lit('">'))
    kind = F.coalesce(F.concat(F.lit(' type="'), F.col("place_type"), F.lit('"')), F.lit(""))
    name = F.regexp_replace(element_of("x", F.col("place_name")), "^<x>|</x>$", "")
    header = [
        F.lit("<fileDesc><sourceDesc><msDesc><history><origin>"), element_of("origPlace", F.col("full_place_name")), F.lit("</origin><provenance"), kind, F.lit('><p><placeName type="modern">none</placeName>'),
        F.coalesce(start, F.lit('<placeName type="ancient">')), name, F.lit("</placeName></p></provenance></history></msDesc></sourceDesc></fileDesc>"),
    ]
    return metadata.metadata_table(metadata.extracted(_record(spark, root, "orig_places", "place_id", header, [])), "orig_places")


def metadata_dates(spark: SparkSession, root: str) -> DataFrame:
    """Bounds of the list of places written as dates of its entries and read back; one in three is an alternative."""
    year = lambda c: F.when(F.col(c) < 0, F.concat(F.lit("-"), F.lpad(F.abs(c).cast("string"), 4, "0"))).otherwise(F.lpad(F.col(c).cast("string"), 4, "0"))
    bound = lambda name, c, rest: F.coalesce(F.concat(F.lit(f' {name}="'), year(c), F.lit(f'{rest}"')), F.lit(""))
    mark = F.when(F.col("id") % 3 == 0, ' xml:id="dateAlternativeX"').otherwise(' cert="low"')
    g = table(spark, root, "export_geo").filter("coalesce(begin_date, 1) <> 0 and coalesce(end_date, 1) <> 0")
    parts = [
        F.lit('<TEI><teiHeader><fileDesc><publicationStmt><idno type="TM">'), F.col("id").cast("string"), F.lit("</idno></publicationStmt><sourceDesc><origDate"), mark, bound("notBefore", "begin_date", "-02-03"),
        bound("notAfter", "end_date", ""), F.lit(">"), F.regexp_replace(element_of("x", F.col("name_latin")), "^<x>|</x>$", ""), F.lit("</origDate></sourceDesc></fileDesc></teiHeader></TEI>"),
    ]
    return metadata.metadata_table(metadata.extracted(g.select(F.lpad(F.col("id").cast("string"), 9, "0").alias("source_path"), F.concat(*parts).alias("xml"))), "orig_dates")


def metadata_works(spark: SparkSession, root: str) -> DataFrame:
    """Ancient works written with titles in two kinds, authors in parts and references, and read back."""
    urn = F.coalesce(F.concat(F.lit(' ref="https://x.org '), F.col("perseus_author_urn"), F.lit('"')), F.lit(""))
    work = F.coalesce(F.concat(F.lit(' ref="x trismegistos.org/authorwork/'), F.col("tm_title_id").cast("string"), F.lit('/more"')), F.lit(""))
    named = F.col("author").contains(" ")
    person = F.concat(element_of("forename", F.substring_index("author", " ", 1)), element_of("surname", F.expr("substring(author, length(substring_index(author, ' ', 1)) + 2)")))
    author = F.coalesce(F.concat(F.lit("<author"), urn, F.lit(">"), F.when(named, person).otherwise(F.regexp_replace(element_of("x", F.col("author")), "^<x>|</x>$", "")), F.lit("</author>")), F.lit(""))
    title = F.coalesce(F.concat(F.lit('<title type="abbreviated">T.</title><title type="main"'), work, F.lit(">"), F.regexp_replace(element_of("x", F.col("title")), "^<x>|</x>$", ""), F.lit("</title>")), F.lit(""))
    body = [F.lit('<div type="bibliography" subtype="ancientEdition"><listBibl><bibl>'), title, author, F.lit("</bibl><bibl/></listBibl></div>")]
    return metadata.metadata_table(metadata.extracted(_record(spark, root, "ancient_editions", "ancient_edition_id", [], body)), "ancient_editions")


def place_references(spark: SparkSession, root: str) -> DataFrame:
    """References with several ids come apart into rows; without one a row stays."""
    o = table(spark, root, "orig_places")
    reference = F.concat_ws(" ", F.concat(F.lit("https://www.trismegistos.org/place/"), F.col("tm_place_id").cast("string")), F.concat(F.lit("https://pleiades.stoa.org/places/"), F.col("pleiades_place_id").cast("string")), F.concat(F.lit("www.trismegistos.org/place/"), F.col("tm_id").cast("string")))
    return o.select("place_id", F.explode_outer(text.tm_place_ids(reference)).alias("tm_place"), text.first_match(reference, text.PLEIADES).try_cast("int").alias("pleiades"))


def edition_language_sql(xml: str) -> str:
    """``languages.edition_language`` in SQL."""
    bare = rf"regexp_replace({xml}, '\A(?:\s|<\?.*?\?>|<!--.*?-->)+', '', 's')"
    attribute = r"""'\bxml:lang\s*=\s*["'']\s*([^"'']*?)\s*["'']'"""
    division = rf"""regexp_extract({bare}, '<(?:[\w.-]+:)?div\b[^>]*?\btype\s*=\s*["'']edition["''][^>]*', 0)"""
    outermost = rf"regexp_extract({bare}, '\A<[^!?>][^>]*', 0)"
    return f"coalesce(nullif(regexp_extract({division}, {attribute}, 1), ''), nullif(regexp_extract({outermost}, {attribute}, 1), ''))"


QUERIES = {f.__name__: f for f in (
    render_text, render_diplomatic, document_languages, snippet_hashes, sentence_chunks, lemmatized_texts, language_names, token_estimates, partition_names, translation_groups,
    record_assembly, metadata_papyri, metadata_editions, keyword_values, metadata_places, metadata_dates, metadata_works, place_references,
)}
_LABELS = """WHEN 'ar' THEN 'arabic' WHEN 'ara' THEN 'arabic' WHEN 'cop' THEN 'coptic' WHEN 'coptic' THEN 'coptic' WHEN 'dem' THEN 'demotic' WHEN 'demotic' THEN 'demotic' WHEN 'egy' THEN 'egyptian'
 WHEN 'egyptian' THEN 'egyptian' WHEN 'el' THEN 'greek' WHEN 'grc' THEN 'greek' WHEN 'greek' THEN 'greek' WHEN 'he' THEN 'hebrew' WHEN 'heb' THEN 'hebrew' WHEN 'hebrew' THEN 'hebrew' WHEN 'la' THEN 'latin'
 WHEN 'lat' THEN 'latin' WHEN 'latin' THEN 'latin' WHEN 'syr' THEN 'syriac' WHEN 'syc' THEN 'syriac' WHEN 'syriac' THEN 'syriac'"""
_TAG = "split_part(replace(lower(trim(language)), '_', '-'), '-', 1)"
_LEMMA = "WHEN 'cop' THEN 'cop' WHEN 'coptic' THEN 'cop' WHEN 'el' THEN 'grc' WHEN 'grc' THEN 'grc' WHEN 'greek' THEN 'grc' WHEN 'la' THEN 'lat' WHEN 'lat' THEN 'lat' WHEN 'latin' THEN 'lat'"
_STEM = "regexp_replace(split_part(source_path, '/', -1), '\\.xml$', '')"
_GROUPS = r"""SELECT regexp_extract(stem, '^(.+)-([0-9]+)$', 1) AS hgv_id, string_agg(source_path, ' ' ORDER BY source_path) AS paths FROM (SELECT DISTINCT source_path, """ + _STEM + r""" AS stem FROM transcriptions WHERE type = 'translation')
        WHERE regexp_matches(stem, '^.+-[0-9]+$') GROUP BY 1"""
_PART = "coalesce(nullif(left(tm_id::VARCHAR, greatest(length(tm_id::VARCHAR) - 3, 0)), ''), '0')"
_NONE = "NULLIF(NULLIF(NULLIF({0}, ''), 'unbekannt'), 'keiner') AS {0}"
_ID = "NULLIF(NULLIF({0}, ''), 'hgvTEMP') AS {0}"
_SQUEEZED = r"NULLIF(trim(regexp_replace({0}, '[ \t\r\n]+', ' ', 'g')), '') AS {0}"
#: Whole XML ends with the end tag of its outermost element.
_WHOLE = r"regexp_matches(xml_content, '</' || regexp_extract(xml_content, '<([A-Za-z][\w.:-]*)', 1) || '\s*>\s*$')"
_BLANK, _INK = BLANKS[:-1] + "*", BLANKS.replace("[", "[^", 1)
_WORDS = f"regexp_extract_all(text, '{_INK}{_BLANK}')"
SQL = {
    "render_text": f"SELECT transcription_id, CASE WHEN {_WHOLE} THEN text END AS rendered FROM transcriptions",
    "document_languages": f"SELECT transcription_id, CASE WHEN {_WHOLE} THEN {edition_language_sql('xml_content')} END AS xml_language, {edition_language_sql('xml_content')} AS tag_language FROM transcriptions",
    "lemmatized_texts": rf"""SELECT transcription_id, CASE WHEN lemma_text IS NULL AND CASE split_part(replace(lower(trim(tag)), '_', '-'), '-', 1) {_LEMMA} END IS NOT NULL
        THEN array_to_string([regexp_replace(lower(w), 'σ$', 'ς') FOR w IN regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}]+')], ' ') ELSE lemma_text END AS lemma_text FROM (SELECT *, coalesce(language, {edition_language_sql('xml_content')}) AS tag FROM transcriptions)""",
    # the words of a text with the blanks after them; a chunk ends after a sentence, at a line end, and after 50 words
    "sentence_chunks": rf"""WITH w AS (SELECT transcription_id, unnest({_WORDS}) AS w, generate_subscripts({_WORDS}, 1) AS i FROM transcriptions),
        l AS (SELECT *, lag(w) OVER (PARTITION BY transcription_id ORDER BY i) AS before FROM w),
        b AS (SELECT *, before IS NULL OR contains(regexp_extract(before, '{_BLANK}$', 0), chr(10)) OR regexp_matches(before, '[.!?;\x{{037E}}\x{{B7}}\x{{0387}}]["''\x{{2019}}\x{{201D}}\x{{BB}})\]]*{_BLANK}$') AS first FROM l),
        s AS (SELECT *, sum(first::INTEGER) OVER (PARTITION BY transcription_id ORDER BY i) AS sentence FROM b), p AS (SELECT *, (row_number() OVER (PARTITION BY transcription_id, sentence ORDER BY i) - 1) // 50 AS piece FROM s),
        c AS (SELECT transcription_id, sentence, piece, regexp_replace(string_agg(w, '' ORDER BY i), '{_BLANK}$', '') AS chunk FROM p GROUP BY ALL)
        SELECT transcription_id, (row_number() OVER (PARTITION BY transcription_id ORDER BY sentence, piece) - 1)::INTEGER AS chunk_index, chunk FROM c""",
    "language_names": f"""SELECT transcription_id, coalesce(CASE {_TAG} {_LABELS} END, nullif(replace(lower(trim(language)), '_', '-'), ''), 'unknown') AS label,
        CASE coalesce({_TAG}, 'el') {_LEMMA} END AS lemma_language FROM transcriptions""",
    "token_estimates": """SELECT type, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN length(text) <= 100 THEN '1-100' WHEN length(text) <= 250 THEN '101-250' WHEN length(text) <= 500 THEN '251-500' ELSE '>500' END AS bucket,
        count(*) AS documents, sum(ceil(strlen(text) / 3.0)::BIGINT)::BIGINT AS tokens FROM transcriptions GROUP BY ALL""",
    "partition_names": f"SELECT source_path, {_PART} AS partition, {_STEM} AS stem FROM papyri",
    "translation_groups": _GROUPS,
    "record_assembly": f"""WITH g AS ({_GROUPS}), t AS (SELECT DISTINCT source_path FROM transcriptions WHERE type = 'transcription')
        SELECT p.tm_id::VARCHAR AS tm_id, p.source_path AS metadata_path, t.source_path AS transcription_path, coalesce(g.paths, '') AS translations FROM (SELECT *, {_STEM} AS stem, {_PART} AS part FROM papyri) p
        LEFT JOIN t ON t.source_path = 'DDbDP/' || p.part || '/' || p.tm_id || '.xml' LEFT JOIN g ON g.hgv_id = p.stem""",
    "metadata_papyri": f"SELECT source_path, tm_id, {', '.join(_ID.format(c) for c in PAPYRI)}, {_NONE.format('title')}, nullif(lower(material), '') AS material, {_NONE.format('current_location')} FROM papyri",
    "metadata_editions": f"SELECT row_number() OVER (ORDER BY principal_edition_id)::INTEGER AS principal_edition_id, tm_id, biblio_id, {', '.join(_SQUEEZED.format(c) for c in ('title', 'author', 'volume', 'number', 'page'))} FROM principal_editions",
    "keyword_values": r"""SELECT row_number() OVER (ORDER BY place_id)::INTEGER AS keyword_id, tm_id, 'hgv' AS scheme, 'place' AS keyword_type, keyword, uncertain FROM
        (SELECT place_id, tm_id, CASE WHEN contains(place_name, '?') THEN trim(regexp_replace(regexp_replace(place_name, '\(\s*\?\s*\)|\?', '', 'g'), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) ELSE trim(regexp_replace(place_name, '[ \t\r\n]+', ' ', 'g')) END AS keyword, contains(place_name, '?') AS uncertain FROM orig_places) WHERE keyword <> ''""",
    "metadata_places": f"""SELECT row_number() OVER (ORDER BY place_id, i)::INTEGER AS place_id, tm_id, coalesce(full_place_name, '') AS full_place_name, place_name, reference AS tm_place_id, pleiades_place_id, place_type, granularity FROM
        (SELECT place_id, tm_id, {_SQUEEZED.format('full_place_name')}, {_SQUEEZED.format('place_name')}, unnest(CASE WHEN tm_place_id IS NULL THEN [tm_id] ELSE [tm_place_id, tm_id] END) AS reference,
        generate_subscripts(CASE WHEN tm_place_id IS NULL THEN [tm_id] ELSE [tm_place_id, tm_id] END, 1) AS i, pleiades_place_id, place_type, granularity FROM orig_places)
        WHERE place_name IS NOT NULL AND coalesce(place_type, 'located') IN ('located', 'found', 'composed', 'sent', 'acquired', 'received') AND granularity IN ('settlement', 'nome', 'region')""",
    "metadata_dates": r"""SELECT row_number() OVER (ORDER BY id)::INTEGER AS date_id, id AS tm_id, trim(regexp_replace(coalesce(name_latin, ''), '[ \t\r\n]+', ' ', 'g')) AS date_text, CASE WHEN id % 3 <> 0 THEN 'low' END AS certainty, NULL::VARCHAR AS precision,
        begin_date AS not_before_year, CASE WHEN begin_date IS NOT NULL THEN 2 END AS not_before_month, CASE WHEN begin_date IS NOT NULL THEN 3 END AS not_before_day, end_date AS not_after_year, NULL::INTEGER AS not_after_month, NULL::INTEGER AS not_after_day,
        id % 3 = 0 AS alternative FROM export_geo WHERE (begin_date IS NOT NULL OR end_date IS NOT NULL) AND coalesce(begin_date, 1) <> 0 AND coalesce(end_date, 1) <> 0""",
    "metadata_works": f"""SELECT row_number() OVER (ORDER BY ancient_edition_id)::INTEGER AS ancient_edition_id, tm_id, {_SQUEEZED.format('title')}, CASE WHEN title IS NOT NULL THEN tm_title_id END AS tm_title_id,
        {_SQUEEZED.format('author')}, CASE WHEN author IS NOT NULL THEN perseus_author_urn END AS perseus_author_urn FROM ancient_editions WHERE title IS NOT NULL OR author IS NOT NULL""",
    "place_references": "SELECT place_id, unnest(CASE WHEN tm_place_id IS NULL THEN [tm_id] ELSE [tm_place_id, tm_id] END) AS tm_place, pleiades_place_id AS pleiades FROM orig_places",
}
