"""Profiles of dates and places on records that are written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.functions.xml import select_text, select_truth, select_values
from ostraka.operators import date_profile, place_profile, profile
from ostraka.operators.xml_shred import shred
from ostraka.plans.nested import NODES
from ostraka.plans.retrieval import BLANKS
from ostraka.plans.texts import element_of, papyri_xml
from ostraka.session import stored
from ostraka.sources.tables import table

KEYS = ["tm_id"]


def _year(column: str) -> Column:
    y = F.col(column)
    return F.when(y < 0, F.concat(F.lit("-"), F.lpad(F.abs(y).cast("string"), 4, "0"))).otherwise(F.lpad(y.cast("string"), 4, "0"))


def _attribute(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f' {name}="'), value, F.lit('"')), F.lit(""))


def _dated(spark: SparkSession, root: str) -> DataFrame:
    """Entries of the list of places as records with two dates each, in eight forms: exact, custom, open, closed, reversed, only text, mixed."""
    form, begin, end = F.col("id") % 8, _year("begin_date"), _year("end_date")
    written = (
        F.when(form == 0, _attribute("when", begin)).when(form == 1, _attribute("when-custom", F.concat(begin, F.lit("-13")))).when(form == 2, _attribute("notBefore", F.concat(begin, F.lit("-02-30"))))
        .when(form == 3, _attribute("notAfter", end)).when(form == 4, F.concat(_attribute("notBefore", begin), _attribute("notAfter", F.concat(end, F.lit("-06")))))
        .when(form == 5, F.concat(_attribute("notBefore", end), _attribute("notAfter", begin))).when(form == 6, F.lit(' cert="low"')).otherwise(F.concat(_attribute("when", F.lit("soon")), _attribute("notBefore", begin), F.lit(' precision="low"')))
    )
    mark = F.when(F.col("id") % 3 == 0, ' xml:id="a"').otherwise("")
    child = F.when(form == 6, '<certainty match="x"/>').otherwise("")
    first = F.concat(F.lit("<origDate"), written, mark, F.lit(">"), child, element_of("hi", F.col("name_latin")), F.lit("text</origDate>"))
    second = F.when(F.col("id") % 5 == 0, F.concat(F.lit("<origDate"), written, F.lit(">other</origDate>"))).otherwise("")
    return table(spark, root, "export_geo").select(F.col("id").alias("tm_id"), F.concat(F.lit("<TEI>"), first, second, F.lit("</TEI>")).alias("xml"))


def _date_nodes(spark: SparkSession, root: str) -> DataFrame:
    return stored(shred(_dated(spark, root), "xml", KEYS), "dates")


def date_shapes(spark: SparkSession, root: str) -> DataFrame:
    return date_profile.shape_profile(date_profile.date_entities(_date_nodes(spark, root), KEYS), "tm_id")


def _date_values(spark: SparkSession, root: str) -> DataFrame:
    return date_profile.date_values(date_profile.date_entities(_date_nodes(spark, root), KEYS), KEYS)


def date_attribute_statuses(spark: SparkSession, root: str) -> DataFrame:
    return date_profile.status_profile(_date_values(spark, root))


def date_anomalies(spark: SparkSession, root: str) -> DataFrame:
    """The first twenty of each kind: the limit is what it is for."""
    return date_profile.anomalies(_date_values(spark, root), "tm_id")


def date_alternatives(spark: SparkSession, root: str) -> DataFrame:
    return date_profile.alternatives(date_profile.intervals(date_profile.date_entities(_date_nodes(spark, root), KEYS)), "tm_id")


def date_children(spark: SparkSession, root: str) -> DataFrame:
    return date_profile.child_annotations(_date_nodes(spark, root), KEYS)


def field_coverage(spark: SparkSession, root: str) -> DataFrame:
    """The fields of the metadata records that papyri makes."""
    records = papyri_xml(spark, root)
    return profile.field_coverage(profile.element_inventory(records, "source_path", "xml"), "source_path", records)


def leaf_texts(spark: SparkSession, root: str) -> DataFrame:
    """Texts of the innermost elements of all transcriptions, with their counts."""
    nodes = stored(shred(table(spark, root, "transcriptions"), "xml_content", ["transcription_id"]), "nodes")
    return profile.leaf_values(nodes, ["transcription_id"])


def xpath_facts(spark: SparkSession, root: str) -> DataFrame:
    """Values, truths and texts that paths select in records of dates."""
    d, xml = _dated(spark, root), F.col("xml")
    return d.select("tm_id", F.array_join(select_values(xml, "//tei:origDate/@when"), " ").alias("exact"), select_truth(xml, "//tei:origDate/tei:certainty[@match='x']").alias("doubtful"), select_text(xml, "//tei:origDate[1]/tei:hi").alias("name"))


def _placed(spark: SparkSession, root: str) -> DataFrame:
    """Rows of orig_places as records that name the place in every scope: present, of origin, and in a provenance of two paragraphs."""
    tm = F.concat(F.lit("https://www.trismegistos.org/place/"), F.col("tm_place_id").cast("string"))
    both = F.nullif(F.concat_ws(" ", tm, F.concat(F.lit("https://pleiades.stoa.org/places/"), F.col("pleiades_place_id").cast("string"))), F.lit(""))
    name = lambda attributes, inner: F.concat(F.lit("<placeName"), *attributes, F.lit(">"), inner, F.lit("</placeName>"))
    text = F.regexp_replace(element_of("x", F.col("place_name")), "^<x>|</x>$", "")
    kind, sub, ref = _attribute("type", F.lit("ancient")), _attribute("subtype", F.col("granularity")), _attribute("ref", both)
    parts = [
        F.lit('<TEI><msDesc><msIdentifier><placeName><settlement ref="http://www.geonames.org/'), F.col("place_id").cast("string"), F.lit(' https://www.wikidata.org/wiki/Q7">Here</settlement></placeName></msIdentifier><history><origin><origPlace>'),
        name([_attribute("key", F.col("place_type")), ref], text), F.lit("</origPlace></origin><provenance>"), name([kind, sub], text), F.lit("<p>"), name([kind, sub, ref], text), name([F.lit(' type="modern" cert="low"')], F.lit("Now")),
        F.lit("</p><p>"), name([ref], text), F.lit("</p><p/></provenance></history></msDesc></TEI>"),
    ]
    return table(spark, root, "orig_places").select(F.col("place_id").alias("tm_id"), F.concat(*parts).alias("xml"))


def place_scopes(spark: SparkSession, root: str) -> DataFrame:
    return place_profile.scope_profile(place_profile.place_mentions(_placed(spark, root)), table(spark, root, "export_geo"))


def place_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    return place_profile.paragraph_profile(place_profile.place_mentions(_placed(spark, root)))


QUERIES = {f.__name__: f for f in (date_shapes, date_attribute_statuses, date_anomalies, date_alternatives, date_children, field_coverage, leaf_texts, xpath_facts, place_scopes, place_paragraphs)}
_Y = "CASE WHEN {0} < 0 THEN '-' || lpad(abs({0})::VARCHAR, 4, '0') ELSE lpad({0}::VARCHAR, 4, '0') END"
_DATES = f"""WITH b AS (SELECT id AS tm_id, id % 8 AS form, {_Y.format('begin_date')} AS b, {_Y.format('end_date')} AS e, begin_date, end_date, id % 3 = 0 AS marked, name_latin FROM export_geo),
o AS (SELECT tm_id, 2 AS node_no, marked, coalesce(trim(regexp_replace('text', '{BLANKS}', ' ', 'g')), '') AS label, b.* EXCLUDE (tm_id, marked) FROM b UNION ALL SELECT tm_id, 99, false, 'other', b.* EXCLUDE (tm_id, marked) FROM b WHERE tm_id % 5 = 0),
a AS (SELECT tm_id, node_no, form, label, marked, CASE form WHEN 0 THEN b WHEN 7 THEN 'soon' END AS w, CASE form WHEN 1 THEN b || '-13' END AS c, CASE form WHEN 2 THEN b || '-02-30' WHEN 4 THEN b WHEN 5 THEN e WHEN 7 THEN b END AS f, CASE form WHEN 3 THEN e WHEN 4 THEN e || '-06' WHEN 5 THEN b END AS t FROM o),
s AS (SELECT *, CASE WHEN w IS NOT NULL AND c IS NULL AND f IS NULL AND t IS NULL THEN 'exact/when' WHEN f IS NOT NULL AND t IS NOT NULL AND w IS NULL AND c IS NULL THEN 'closed range' WHEN f IS NOT NULL AND w IS NULL AND c IS NULL THEN 'open upper bound (notBefore only)'
  WHEN t IS NOT NULL AND w IS NULL AND c IS NULL THEN 'open lower bound (notAfter only)' WHEN c IS NOT NULL AND w IS NULL AND f IS NULL AND t IS NULL THEN 'custom exact date' WHEN w IS NULL AND c IS NULL AND f IS NULL AND t IS NULL THEN 'text only' ELSE 'mixed' END AS shape FROM a),
v AS (SELECT * FROM (SELECT tm_id, node_no, unnest([{{'attribute': 'when', 'value': w}}, {{'attribute': 'notBefore', 'value': f}}, {{'attribute': 'notAfter', 'value': t}}, {{'attribute': 'when-custom', 'value': c}}], recursive := true) FROM a) WHERE value IS NOT NULL),
p AS (SELECT *, try_cast(nullif(regexp_extract(value, '^-?[0-9]{{4,}}'), '') AS INTEGER) AS y, CASE WHEN regexp_matches(value, '^-?[0-9]{{4,}}-[0-9]{{2}}-[0-9]{{2}}$') THEN 'day' WHEN regexp_matches(value, '^-?[0-9]{{4,}}-[0-9]{{2}}$') THEN 'month' WHEN regexp_matches(value, '^-?[0-9]{{4,}}$') THEN 'year' END AS granularity FROM v),
q AS (SELECT *, CASE WHEN granularity IS NULL THEN 'invalid_lexical' WHEN y = 0 THEN 'year_zero' WHEN value LIKE '%-13' THEN 'invalid_month' WHEN value LIKE '%-02-30' THEN 'invalid_gregorian_day' ELSE 'valid' END AS status, CASE WHEN y < 0 THEN 'BCE' WHEN y > 0 THEN 'CE' WHEN y = 0 THEN 'year zero' END AS era FROM p)"""
_MENTIONS = """WITH m AS (SELECT place_id AS tm_id, place_name, place_type, granularity, tm_place_id, tm_place_id IS NOT NULL AS tm, pleiades_place_id IS NOT NULL AS pl FROM orig_places),
r AS (SELECT 'current_settlement' AS scope, tm_id, 'Here' AS label, true AS ref, false AS key, false AS tm, false AS pl, true AS other, NULL AS id FROM m
  UNION ALL SELECT 'origin_place_name', tm_id, place_name, tm OR pl, place_type IS NOT NULL, tm, pl, false, tm_place_id FROM m UNION ALL SELECT 'provenance_place', tm_id, place_name, false, false, false, false, false, NULL FROM m
  UNION ALL SELECT 'provenance_place', tm_id, place_name, tm OR pl, false, tm, pl, false, tm_place_id FROM m UNION ALL SELECT 'provenance_place', tm_id, 'Now', false, false, false, false, false, NULL FROM m
  UNION ALL SELECT 'provenance_place', tm_id, place_name, tm OR pl, false, tm, pl, false, tm_place_id FROM m)"""
SQL = {
    "date_shapes": _DATES + " SELECT shape, count(*) AS dates, count(DISTINCT tm_id) AS records, count(*) FILTER (form = 6) AS with_cert, count(*) FILTER (form = 7) AS with_precision, count(DISTINCT label) AS labels FROM s GROUP BY shape",
    "date_attribute_statuses": _DATES + " SELECT attribute, status, granularity, era, count(*) AS dates, min(y) AS first_year, max(y) AS last_year FROM q GROUP BY ALL",
    "date_anomalies": _DATES + " SELECT status, row_number() OVER (PARTITION BY status ORDER BY tm_id, node_no, attribute)::INTEGER AS place, tm_id, attribute, value FROM q WHERE status <> 'valid' QUALIFY place <= 20",
    "date_alternatives": _DATES + """ SELECT CASE WHEN n = named THEN 'all' WHEN named > 0 THEN 'some' ELSE 'none' END AS identified, count(*) AS records, count(*) AS same_attributes, count(*) AS same_years, max(n) AS most_dates
        FROM (SELECT tm_id, count(*) AS n, count(*) FILTER (marked) AS named FROM a GROUP BY tm_id HAVING count(*) > 1) GROUP BY 1""",
    "date_children": _DATES + """ SELECT * FROM (SELECT 'certainty' AS child, 'match' AS attribute, 'x' AS value, count(*) AS times, count(*) AS records FROM b WHERE form = 6 UNION ALL SELECT 'hi', NULL, NULL, count(*), count(*) FROM b WHERE name_latin IS NOT NULL) WHERE times > 0""",
    "field_coverage": "WITH n AS (SELECT count(*) AS n FROM papyri), c AS (SELECT unnest([" + ", ".join(f"{{'field': '{f}', 'path': '{p}'}}" for f, p in profile.FIELDS) + """], recursive := true)),
        o AS (SELECT 'Document title' AS field, 1 AS times FROM papyri WHERE title IS NOT NULL UNION ALL SELECT 'Collection', 1 FROM papyri WHERE current_location IS NOT NULL UNION ALL SELECT 'Material', 1 FROM papyri WHERE material IS NOT NULL
          UNION ALL SELECT 'Publication identifier', len(list_filter([tm_id::VARCHAR, dclp_hybrid_id::VARCHAR, ddb_filename::VARCHAR, ddb_hybrid_id::VARCHAR, hgv_id::VARCHAR, ldab_id::VARCHAR, mp3_id::VARCHAR], lambda x: x IS NOT NULL)) FROM papyri),
        g AS (SELECT field, count(*) AS documents, sum(times)::BIGINT AS occurrences FROM o GROUP BY field)
        SELECT c.field, path, coalesce(documents, 0) AS documents, round(100.0 * coalesce(documents, 0) / n::DOUBLE, 2)::DOUBLE AS coverage, coalesce(occurrences, 0) AS occurrences, round(occurrences / documents::DOUBLE, 2) AS per_record FROM c LEFT JOIN g ON c.field = g.field, n""",
    "leaf_texts": NODES + """ SELECT label, scalar AS value, count(*) AS times, count(DISTINCT transcription_id) AS records FROM e JOIN g USING (transcription_id, node_no)
        WHERE (transcription_id, node_no) NOT IN (SELECT (transcription_id, parent_no) FROM e) GROUP BY ALL""",
    "xpath_facts": _DATES + " SELECT b.tm_id, coalesce(w.exact, '') AS exact, form = 6 AS doubtful, coalesce(name_latin, '') AS name FROM b LEFT JOIN (SELECT tm_id, string_agg(w, ' ' ORDER BY node_no) AS exact FROM a WHERE w IS NOT NULL GROUP BY tm_id) w ON w.tm_id = b.tm_id",
    "place_scopes": _MENTIONS + f""" SELECT scope, count(*) AS names, count(DISTINCT tm_id) AS records, count(DISTINCT coalesce(nullif(trim(regexp_replace(label, '[ \\t\\r\\n]+', ' ', 'g')), ''), '(empty)')) AS labels, count(*) FILTER (ref) AS with_ref, count(*) FILTER (key) AS with_key, count(*) FILTER (tm) AS with_trismegistos,
        count(*) FILTER (pl) AS with_pleiades, count(*) FILTER (other) AS with_wikidata, count(*) FILTER (other) AS with_geonames, 0::BIGINT AS several_ids, count(g.id) AS resolved, count(*) FILTER (g.id IS NOT NULL AND coalesce(coordinates, '') <> '') AS with_coordinates,
        count(*) FILTER (begin_date IS NOT NULL OR end_date IS NOT NULL) AS with_dates FROM r LEFT JOIN export_geo g ON r.id = g.id GROUP BY scope""",
    "place_paragraphs": _MENTIONS + """ SELECT signatures, with_ids, count(*) AS paragraphs, count(DISTINCT tm_id) AS records FROM (
        SELECT tm_id, 'ancient:' || granularity || CASE WHEN tm OR pl THEN ':ref' ELSE '' END || ' | modern:cert=low' AS signatures, CASE WHEN tm THEN 'some' ELSE 'none' END AS with_ids FROM m
        UNION ALL SELECT tm_id, '(no type)' || CASE WHEN tm OR pl THEN ':ref' ELSE '' END, CASE WHEN tm THEN 'all' ELSE 'none' END FROM m) GROUP BY ALL""",
}
