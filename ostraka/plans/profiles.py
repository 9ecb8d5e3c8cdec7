"""Profiles, dates, places, references and image links on the corpus tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.functions import dates, text
from ostraka.operators import images, profile
from ostraka.plans.nested import NODES
from ostraka.plans.retrieval import BLANKS
from ostraka.sources.tables import table


def path_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Elements and attributes by path: records, occurrences, least and most in a record."""
    items = profile.element_inventory(table(spark, root, "transcriptions"), "transcription_id", "xml_content")
    return profile.frequency(items.filter("kind <> 'error'"), "transcription_id", ["kind", "path", "name"], F.col("times"))


def attribute_values(spark: SparkSession, root: str) -> DataFrame:
    """The twelve most frequent values of every attribute, by element path."""
    items = profile.element_inventory(table(spark, root, "transcriptions"), "transcription_id", "xml_content").filter("kind = 'attribute'")
    counted = items.groupBy("path", "name", "value").agg(F.sum("times").alias("occurrences"))
    return profile.top_values(counted, ["path", "name"], "value", "occurrences", 12)


def place_type_values(spark: SparkSession, root: str) -> DataFrame:
    return profile.value_distribution(table(spark, root, "orig_places"), ["granularity"], "place_type")


def top_places_by_type(spark: SparkSession, root: str) -> DataFrame:
    d = profile.value_distribution(table(spark, root, "orig_places"), ["place_type"], "place_name")
    d = d.unionByName(profile.value_distribution(table(spark, root, "orig_places").filter("place_type is null").withColumn("place_type", F.lit("none")), ["place_type"], "place_name"))
    return profile.top_values(d.filter("place_type is not null"), ["place_type"], "place_name", "occurrences", 20).select("place_type", "place_name", "occurrences", "place")


def place_frequency(spark: SparkSession, root: str) -> DataFrame:
    return profile.frequency(table(spark, root, "orig_places"), "tm_id", ["place_name"])


def papyri_coverage(spark: SparkSession, root: str) -> DataFrame:
    return profile.coverage(table(spark, root, "papyri"), ["dclp_id", "dclp_hybrid_id", "ddb_filename", "hgv_id", "ldab_id", "mp3_id", "title", "material", "current_location"])


def edition_histogram(spark: SparkSession, root: str) -> DataFrame:
    records = table(spark, root, "papyri").select("tm_id").distinct()
    return profile.cardinality_histogram(records, table(spark, root, "principal_editions"), "tm_id")


def _bound(column: str) -> Column:
    """A year of the list of places as a date of four figures."""
    year = F.col(column)
    return F.when(year < 0, F.concat(F.lit("-"), F.lpad(F.abs(year).cast("string"), 4, "0"))).when(year >= 0, F.lpad(year.cast("string"), 4, "0"))


def date_statuses(spark: SparkSession, root: str) -> DataFrame:
    """Years of the list of places, with months and days put on, parsed and told apart by status."""
    g = table(spark, root, "export_geo")
    end = F.concat(_bound("end_date"), F.lit("-"), F.lpad((F.col("id") % 14).cast("string"), 2, "0"), F.lit("-"), F.lpad((F.col("id") % 33).cast("string"), 2, "0"))
    values = g.select(F.explode(F.array(_bound("begin_date"), end)).alias("value")).filter("value is not null")
    parsed = values.select(dates.parse_date(F.col("value"), gregorian=True).alias("d"))
    return parsed.groupBy("d.status", "d.granularity").agg(F.count(F.lit(1)).alias("dates"), F.min("d.year").alias("first_year"), F.max("d.year").alias("last_year"))


def interval_widths(spark: SparkSession, root: str) -> DataFrame:
    g = table(spark, root, "export_geo")
    s, e = F.col("begin_date"), F.col("end_date")
    return g.select("id", dates.year_width(s, e).alias("width"), dates.width_bucket(s, e).alias("bucket"), dates.year_ordinal(s).alias("ordinal"))


def interval_overlap(spark: SparkSession, root: str) -> DataFrame:
    """Records that name a place that existed in the years 101 to 200, by a left semi join."""
    g = table(spark, root, "export_geo")
    there = g.filter(dates.overlaps(F.col("begin_date"), F.col("end_date"), 101, 200)).select(F.col("id").alias("tm_place_id"))
    return table(spark, root, "orig_places").join(there, "tm_place_id", "left_semi").select("tm_id").distinct()


def interval_windows(spark: SparkSession, root: str) -> DataFrame:
    """Records by whether any, and whether all, of their places overlap or lie in 200 BCE to 100 CE."""
    g = table(spark, root, "export_geo").select(F.col("id").alias("tm_place_id"), "begin_date", "end_date")
    rows = table(spark, root, "orig_places").join(g, "tm_place_id", "left")
    return profile.date_windows(rows, "tm_id", "begin_date", "end_date", -200, 100)


def gazetteer_coverage(spark: SparkSession, root: str) -> DataFrame:
    places = table(spark, root, "orig_places").withColumn("scope", F.coalesce("place_type", F.lit("none")))
    return profile.place_coverage(places, table(spark, root, "export_geo"), "scope", "tm_place_id")


def alias_matches(spark: SparkSession, root: str) -> DataFrame:
    """Names of unlinked places that are a name of none, one or several entries of the list."""
    names = profile.gazetteer_names(table(spark, root, "export_geo"), ["name_latin", "name_standard", "unicode_greek", "unicode_coptic", "location"])
    unlinked = table(spark, root, "orig_places").filter("tm_place_id is null")
    return profile.label_matches(unlinked, "place_name", names)


def reference_resolution(spark: SparkSession, root: str) -> DataFrame:
    return profile.reference_resolution(table(spark, root, "orig_places"), "tm_place_id", table(spark, root, "export_geo"), "id")


def length_profile(spark: SparkSession, root: str) -> DataFrame:
    return profile.length_profile(table(spark, root, "transcriptions"), "text")


def duplicate_records(spark: SparkSession, root: str) -> DataFrame:
    """TM ids with several metadata files."""
    return table(spark, root, "papyri").groupBy("tm_id").agg(F.count(F.lit(1)).alias("files")).filter("files > 1")


def record_sets(spark: SparkSession, root: str) -> DataFrame:
    """Records with a transcription, a translation, both, or only one of them."""
    d = table(spark, root, "transcriptions")
    a, b = (d.filter(F.col("type") == t).select("tm_id").distinct() for t in ("transcription", "translation"))
    parts = {"both": a.intersect(b), "transcription_only": a.subtract(b), "translation_only": b.subtract(a)}
    out = [p.select(F.lit(n).alias("part"), "tm_id") for n, p in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


#: Addresses made of the identifiers of records, one form for each of several sites.
#: Addresses with the handler that serves them, "" for none, one or more of every site: forms that fit and near misses.
SITES = (
    ("http://bipab.aphrodito.info/pages_html/a{}.html", "Aphrodito"), ("http://bipab.aphrodito.info/other/a{}.html", ""), ("https://www.britishmuseum.org/collection/object/Y_EA{}", "BritishMuseum"), ("https://www.britishmuseum.org/visit/{}", ""),
    ("https://digital.bodleian.ox.ac.uk/objects/01234567-89ab-cdef-0123-456789abcdef/", "Bodleian"), ("https://digital.bodleian.ox.ac.uk/objects/{}/", ""), ("http://ipap.csad.ox.ac.uk/4DLink4/4DACTION/IPAPwebquery?vPub={}", "CairoMuseum"),
    ("http://ipap.csad.ox.ac.uk/Cairo/{}.JPG", "CairoMuseum"), ("http://ipap.csad.ox.ac.uk/page/{}.html", ""), ("https://doi.org/10.1/{}", "DOI"), ("http://doi.org/10.1/{}", ""), ("http://www.ifao.egnet.net/bases/publications/fifao67/?id={}", "Egnet"),
    ("http://www.ifao.egnet.net/bases/publications/fifao67?os={}", "Egnet"), ("http://www.ifao.egnet.net/bases/publications/fifao81/?os={}", ""), ("http://www.ifao.egnet.net/bases/publications/fifao67/?n={}", ""), ("https://collections.louvre.fr/en/ark:/53355/cl{}", "Louvre"),
    ("https://collections.louvre.fr/en/album/{}", ""), ("https://www.metmuseum.org/art/collection/search/{}", "MetMuseum"), ("https://www.metmuseum.org/art/{}", ""), ("https://api.nakala.fr/iiif/10.34847/nkl.ab{}/0123456789abcdef0123456789abcdef01234567/full", "Nakala"),
    ("https://api.nakala.fr/data/{}", ""), ("http://data.onb.ac.at/rec/RZ{}", "ONB"), ("http://data.onb.ac.at/record/RZ{}", ""), ("https://onb.digital/result/{}", "ONB"), ("https://digital.onb.ac.at/rep/access/open/{}", "ONB"), ("https://digital.onb.ac.at/rep/{}", ""),
    ("https://viewer.onb.ac.at/{}", "ONB"), ("https://search.onb.ac.at/primo-explore/fulldisplay?docid={}", "ONB"), ("https://api.onb.ac.at/iiif/presentation/v3/manifest/{}", "ONB"), ("https://api.onb.ac.at/iiif/image/{}", ""),
    ("https://portal.sds.ox.ac.uk/articles/online_resource/P_Oxy/{}", "Oxford"), ("https://portal.sds.ox.ac.uk/authors/{}", ""), ("https://berlpap.smb.museum/{}/", "BerlPap"), ("https://www.papyrusportal.de/receive/P_{}", "PapyrusPortal"), ("https://www.papyrusportal.de/about/{}", ""),
    ("http://www.psi-online.it/documents/psi;{}", "PSIOnline"), ("http://www.psi-online.it/documents/download?filen={}", ""), ("http://www.psi-online.it/documents/", ""), ("https://digi.ub.uni-heidelberg.de/diglit/p{}", "UBHeidelberg"), ("https://digi.ub.uni-heidelberg.de/diglit/p{}/0001", ""),
    ("https://resolver.sub.uni-hamburg.de/kitodo/HANSh{}", "UniHamburg"), ("https://resolver.sub.uni-hamburg.de/x/HANSh{}", ""), ("http://www.uni-koeln.de/phil-fak/ifa/NRWakademie/papyrologie/K{}.html", "UniKoeln"), ("http://www.uni-koeln.de/phil-fak/{}.html", ""),
    ("https://quod.lib.umich.edu/a/apis/x-{}", "UMichigan"), ("https://quod.lib.umich.edu/a/apis/y-{}", ""), ("http://petriecat.museums.ucl.ac.uk/dispatcher.aspx?action=search&database=ChoiceUCLPC&search=accession_number%3D%27UC{}%27", "UCL"),
    ("http://petriecat.museums.ucl.ac.uk/dispatcher.aspx?action=search&database=other&search=accession_number%3D%27UC{}%27", ""), ("http://petriecat.museums.ucl.ac.uk/dispatcher.aspx?action=search&database=ChoiceUCLPC&search=title%3D{}", ""),
    ("https://digicoll.lib.berkeley.edu/record/{}", "UCBerkeley"), ("https://digicoll.lib.berkeley.edu/search/{}", ""), ("http://www.papyrology.uw.edu.pl/papyri/{}.htm", "Warsaw"), ("http://www.papyrology.uw.edu.pl/{}.htm", ""), ("http://hdl.handle.net/10079/digcoll/{}", "Yale"),
    ("http://hdl.handle.net/10079/{}", ""), ("https://collections.library.yale.edu/catalog/{}", "Yale"), ("https://collections.library.yale.edu/about/{}", ""), ("https://example.org/{}", ""), ("", ""), ("not an address {}", ""),
)
ADDRESSES = ("https://quod.lib.umich.edu/a/apis/x-{}", "https://collections.library.yale.edu/catalog/{}", "http://www.papyrology.uw.edu.pl/papyri/{}.htm", "https://doi.org/10.1/{}", "https://example.org/{}")


def _links(spark: SparkSession, root: str) -> DataFrame:
    address = F.element_at(F.array(*[F.lit(a) for a in ADDRESSES]), (F.col("tm_id") % len(ADDRESSES) + 1).cast("int"))
    return table(spark, root, "papyri").select(F.col("tm_id").cast("string").alias("tm_id"), F.replace(address, F.lit("{}"), F.col("tm_id").cast("string")).alias("url")).distinct()


def image_handlers(spark: SparkSession, root: str) -> DataFrame:
    """Every form of address of every site, with the identifiers of all records put in."""
    forms = F.explode(F.array(*[F.lit(a) for a, _ in SITES]))
    urls = table(spark, root, "papyri").select(F.col("tm_id").cast("string").alias("tm_id"), forms.alias("form")).select("tm_id", F.replace("form", F.lit("{}"), F.col("tm_id")).alias("url")).distinct()
    links = urls.withColumn("handler", images.responsible_handler(F.col("url")))
    return links.select("tm_id", "url", "handler", images.manifest_url(F.col("url"), F.col("handler")).alias("manifest"))


def graphic_links(spark: SparkSession, root: str) -> DataFrame:
    """Addresses written into records as graphics, one of them without an address, and read back."""
    links = _links(spark, root).groupBy("tm_id").agg(F.array_sort(F.collect_list("url")).alias("urls"))
    marks = F.array_join(F.transform("urls", lambda u: F.concat(F.lit('<graphic url="'), F.replace(u, F.lit("&"), F.lit("&amp;")), F.lit('"/>'))), "")
    xml = F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><facsimile><graphic/>'), marks, F.lit('<surface><graphic url="x"/></surface></facsimile></TEI>'))
    return images.graphic_links(links.select("tm_id", xml.alias("xml")))


def image_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """Links by handler and outcome: records with an LDAB id are taken as done, those with an MP3 id as broken."""
    links, p = _links(spark, root), table(spark, root, "papyri").withColumn("tm_id", F.col("tm_id").cast("string"))
    done = links.join(p.filter("ldab_id is not null").select("tm_id"), "tm_id", "left_semi").select(F.col("url").alias("source_url"), F.lit(None).cast("string").alias("effective_url"))
    broken = links.join(p.filter("mp3_id is not null").select("tm_id"), "tm_id", "left_semi").select(F.concat_ws(": ", "tm_id", "url").alias("entry"))
    found = images.classified_links(links, done, broken)
    return found.groupBy("handler", "outcome").agg(F.count(F.lit(1)).alias("links"))


def url_prefixes(spark: SparkSession, root: str) -> DataFrame:
    prefix = F.regexp_extract("url", "^(https?://[^/]+/)", 1)
    return _links(spark, root).groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("links")).orderBy(F.desc("links"), "prefix").limit(30)


def name_variants(spark: SparkSession, root: str) -> DataFrame:
    """Every name in the list of places with its variants."""
    return table(spark, root, "export_geo").select("id", F.explode(text.split_variants(F.col("name_standard"))).alias("variant"))


QUERIES = {f.__name__: f for f in (
    path_inventory, attribute_values, place_type_values, top_places_by_type, place_frequency, papyri_coverage, edition_histogram, date_statuses, interval_widths, interval_overlap,
    interval_windows, gazetteer_coverage, alias_matches, reference_resolution, length_profile, duplicate_records, record_sets, image_handlers, graphic_links, image_outcomes, url_prefixes, name_variants,
)}
_FIELDS = ("dclp_id", "dclp_hybrid_id", "ddb_filename", "hgv_id", "ldab_id", "mp3_id", "title", "material", "current_location")
_OVER = "((begin_date IS NOT NULL OR end_date IS NOT NULL) AND coalesce(begin_date <= {1}, true) AND coalesce(end_date >= {0}, true))"
_IN = "coalesce(begin_date >= {0} AND end_date <= {1}, false)"
_YEAR = "CASE WHEN {0} < 0 THEN '-' || lpad(abs({0})::VARCHAR, 4, '0') WHEN {0} >= 0 THEN lpad({0}::VARCHAR, 4, '0') END"
_LINKS = "(SELECT DISTINCT tm_id::VARCHAR AS tm_id, replace([" + ", ".join(f"'{a}'" for a in ADDRESSES) + f"][tm_id % {len(ADDRESSES)} + 1], '{{}}', tm_id::VARCHAR) AS url FROM papyri)"
_HANDLER = "CASE WHEN url LIKE '%umich%' THEN 'UMichigan' WHEN url LIKE '%yale%' THEN 'Yale' WHEN url LIKE '%uw.edu.pl%' THEN 'Warsaw' WHEN url LIKE '%doi.org%' THEN 'DOI' END"
_PATHS = NODES + """, w AS (SELECT transcription_id, node_no, '/' || label AS path, label FROM e WHERE parent_no = 0 UNION ALL SELECT e.transcription_id, e.node_no, w.path || '/' || e.label, e.label FROM e JOIN w ON e.transcription_id = w.transcription_id AND e.parent_no = w.node_no),
z AS (SELECT transcription_id, w.path, x.label AS name, scalar, node_no FROM x JOIN w USING (transcription_id, node_no) WHERE NOT declares)"""
SQL = {
    "path_inventory": _PATHS + """, i AS (SELECT transcription_id, 'element' AS kind, path, label AS name FROM w UNION ALL SELECT transcription_id, 'attribute', path, name FROM z
          UNION ALL SELECT transcription_id, 'attribute_set', path, string_agg(name, ', ' ORDER BY name) FROM z GROUP BY transcription_id, path, node_no)
        SELECT kind, path, name, count(*) AS documents, sum(n)::BIGINT AS occurrences, min(n) AS min_per_document, max(n) AS max_per_document FROM (SELECT transcription_id, kind, path, name, count(*) AS n FROM i GROUP BY ALL) GROUP BY ALL""",
    "attribute_values": _PATHS + " SELECT path, name, scalar AS value, count(*) AS occurrences, row_number() OVER (PARTITION BY path, name ORDER BY count(*) DESC, scalar)::INTEGER AS place FROM z GROUP BY path, name, scalar QUALIFY place <= 12",
    "alias_matches": """WITH v AS (SELECT id, unnest(list_concat([n], list_concat(string_split(n, ' - '), string_split(n, ';')))) AS v FROM (SELECT id, unnest([name_latin, name_standard, unicode_greek, unicode_coptic, location]) AS n FROM export_geo)),
        a AS (SELECT DISTINCT id, {0} AS name FROM v WHERE trim(v) <> ''), c AS (SELECT name, count(*) AS entries, min(id) AS first_id FROM a WHERE name <> '' GROUP BY name),
        l AS (SELECT DISTINCT place_name AS label FROM orig_places WHERE tm_place_id IS NULL AND place_name IS NOT NULL)
        SELECT label, coalesce(entries, 0) AS entries, CASE WHEN entries IS NULL THEN 'none' WHEN entries = 1 THEN 'single' ELSE 'ambiguous' END AS status, CASE WHEN entries = 1 THEN first_id END AS geo_id
        FROM l LEFT JOIN c ON c.name = {1}""".format(*(rf"trim(regexp_replace(replace(lower(nfc_normalize({x})), 'ς', 'σ'), '{BLANKS}', ' ', 'g'))" for x in ("v", "label"))),
    "place_type_values": "SELECT granularity, place_type, count(*) AS occurrences, count(*) OVER (PARTITION BY granularity) > 10000 AS many_values FROM orig_places GROUP BY granularity, place_type",
    "top_places_by_type": "SELECT * FROM (SELECT coalesce(place_type, 'none') AS place_type, place_name, count(*) AS occurrences, row_number() OVER (PARTITION BY coalesce(place_type, 'none') ORDER BY count(*) DESC, place_name)::INTEGER AS place FROM orig_places GROUP BY 1, 2) WHERE place <= 20",
    "place_frequency": "SELECT place_name, count(*) AS documents, sum(n)::BIGINT AS occurrences, min(n) AS min_per_document, max(n) AS max_per_document FROM (SELECT tm_id, place_name, count(*) AS n FROM orig_places GROUP BY ALL) GROUP BY place_name",
    "papyri_coverage": " UNION ALL ".join(f"SELECT '{c}' AS field, count(nullif({c}::VARCHAR, '')) AS present, count(*) AS total, round(100.0 * count(nullif({c}::VARCHAR, '')) / count(*)::DOUBLE, 2)::DOUBLE AS percentage FROM papyri" for c in _FIELDS),
    "edition_histogram": "SELECT coalesce(n, 0) AS items, count(*) AS documents FROM (SELECT DISTINCT tm_id FROM papyri) LEFT JOIN (SELECT tm_id, count(*) AS n FROM principal_editions GROUP BY tm_id) USING (tm_id) GROUP BY 1",
    "date_statuses": f"""WITH v AS (SELECT {_YEAR.format('begin_date')} AS value FROM export_geo UNION ALL SELECT {_YEAR.format('end_date')} || '-' || lpad((id % 14)::VARCHAR, 2, '0') || '-' || lpad((id % 33)::VARCHAR, 2, '0') FROM export_geo),
        p AS (SELECT regexp_extract(value, '^(-?[0-9]+)', 1)::INTEGER AS y, try_cast(nullif(regexp_extract(value, '^-?[0-9]+-([0-9]+)', 1), '') AS INTEGER) AS m, try_cast(nullif(regexp_extract(value, '-([0-9]+)$', 1), '') AS INTEGER) AS d0, value FROM v WHERE value IS NOT NULL),
        q AS (SELECT y, m, CASE WHEN m IS NOT NULL THEN d0 END AS d, CASE WHEN y < 0 THEN y + 1 ELSE y END AS g FROM p)
        SELECT CASE WHEN y = 0 THEN 'year_zero' WHEN m NOT BETWEEN 1 AND 12 THEN 'invalid_month' WHEN d NOT BETWEEN 1 AND 31 THEN 'invalid_day'
          WHEN d > CASE WHEN m = 2 THEN CASE WHEN (g % 4 = 0 AND g % 100 <> 0) OR g % 400 = 0 THEN 29 ELSE 28 END WHEN m IN (4, 6, 9, 11) THEN 30 ELSE 31 END THEN 'invalid_gregorian_day' ELSE 'valid' END AS status,
          CASE WHEN d IS NOT NULL THEN 'day' WHEN m IS NOT NULL THEN 'month' ELSE 'year' END AS granularity, count(*) AS dates, min(y) AS first_year, max(y) AS last_year FROM q GROUP BY 1, 2""",
    "interval_widths": """WITH w AS (SELECT id, begin_date AS s, end_date AS e, end_date - begin_date + 1 - CASE WHEN begin_date < 0 AND end_date > 0 THEN 1 ELSE 0 END AS width FROM export_geo)
        SELECT id, width, CASE WHEN s IS NULL AND e IS NULL THEN 'text_only' WHEN s IS NULL OR e IS NULL THEN 'open' WHEN width <= 1 THEN '1' WHEN width <= 10 THEN '2-10' WHEN width <= 50 THEN '11-50' WHEN width <= 100 THEN '51-100'
        WHEN width <= 200 THEN '101-200' ELSE '>200' END AS bucket, CASE WHEN s < 0 THEN s ELSE s - 1 END AS ordinal FROM w""",
    "interval_overlap": f"SELECT DISTINCT tm_id FROM orig_places WHERE tm_place_id IN (SELECT id FROM export_geo WHERE {_OVER.format(101, 200)})",
    "interval_windows": f"""SELECT count(*) FILTER (a) AS any_overlaps, count(*) FILTER (b) AS all_overlap, count(*) FILTER (c) AS any_contained, count(*) FILTER (d) AS all_contained FROM (SELECT tm_id, bool_or({_OVER.format(-200, 100)}) AS a,
        bool_and({_OVER.format(-200, 100)}) AS b, bool_or({_IN.format(-200, 100)}) AS c, bool_and({_IN.format(-200, 100)}) AS d FROM orig_places LEFT JOIN export_geo ON tm_place_id = id GROUP BY tm_id)""",
    "gazetteer_coverage": """SELECT coalesce(place_type, 'none') AS scope, count(*) AS mentions, count(tm_place_id) AS with_reference, count(id) AS resolved, count(*) FILTER (id IS NOT NULL AND coalesce(coordinates, '') <> '') AS with_coordinates,
        count(*) FILTER (begin_date IS NOT NULL OR end_date IS NOT NULL) AS with_dates, count(DISTINCT id) AS entries FROM orig_places LEFT JOIN export_geo ON tm_place_id = id GROUP BY 1""",
    "reference_resolution": "SELECT count(*) AS occurrences, count(DISTINCT tm_place_id) AS ids, count(DISTINCT tm_place_id) FILTER (tm_place_id IN (SELECT id FROM export_geo)) AS resolved, count(DISTINCT tm_place_id) FILTER (tm_place_id NOT IN (SELECT id FROM export_geo)) AS missing FROM orig_places WHERE tm_place_id IS NOT NULL",
    "length_profile": "SELECT " + ", ".join(f"quantile_cont(n, {p}) AS p{int(100 * p)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)) + r", max(n) AS longest FROM (SELECT len(list_filter(regexp_split_to_array(text, '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda w: w <> ''))::DOUBLE AS n FROM transcriptions WHERE text IS NOT NULL)",
    "duplicate_records": "SELECT tm_id, count(*) AS files FROM papyri GROUP BY tm_id HAVING count(*) > 1",
    "record_sets": """SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 'transcription_only' ELSE 'translation_only' END AS part, tm_id FROM (SELECT tm_id, bool_or(type = 'transcription') AS a, bool_or(type = 'translation') AS b FROM transcriptions GROUP BY tm_id)""",
    # the handlers are those said by hand in SITES
    "image_handlers": "WITH f AS (SELECT unnest([" + ", ".join(f"{{'form': '{a}', 'handler': '{h}'}}" for a, h in SITES) + """], recursive := true))
        SELECT DISTINCT tm_id::VARCHAR AS tm_id, replace(form, '{}', tm_id::VARCHAR) AS url, nullif(handler, '') AS handler, CASE WHEN form LIKE '%umich.edu/a/apis/x-%' THEN 'https://quod.lib.umich.edu/cgi/i/image/api/manifest/apis:' || tm_id WHEN form LIKE '%yale.edu/catalog%' THEN 'https://collections.library.yale.edu/manifests/' || tm_id
        WHEN form LIKE '%kitodo%' THEN 'https://iiif.sub.uni-hamburg.de/object/HANSh' || tm_id || '/manifest' WHEN form LIKE '%0123-456789abcdef/' THEN 'https://iiif.bodleian.ox.ac.uk/iiif/manifest/01234567-89ab-cdef-0123-456789abcdef.json' END AS manifest FROM papyri, f""",
    "graphic_links": f"SELECT tm_id, url FROM {_LINKS} UNION ALL SELECT DISTINCT tm_id::VARCHAR, 'x' FROM papyri",
    "image_outcomes": f"""SELECT handler, outcome, count(*) AS links FROM (SELECT {_HANDLER} AS handler, CASE WHEN tm_id IN (SELECT tm_id::VARCHAR FROM papyri WHERE ldab_id IS NOT NULL) THEN 'already_present'
        WHEN tm_id IN (SELECT tm_id::VARCHAR FROM papyri WHERE mp3_id IS NOT NULL) THEN 'broken' WHEN {_HANDLER} IS NULL THEN 'todo' ELSE 'queued' END AS outcome FROM {_LINKS}) GROUP BY ALL""",
    "url_prefixes": f"SELECT regexp_extract(url, '^(https?://[^/]+/)', 1) AS prefix, count(*) AS links FROM {_LINKS} GROUP BY 1 ORDER BY links DESC, prefix LIMIT 30",
    "name_variants": "SELECT DISTINCT id, trim(v) AS variant FROM (SELECT id, unnest(list_concat([name_standard], list_concat(string_split(name_standard, ' - '), string_split(name_standard, ';')))) AS v FROM export_geo) WHERE trim(v) <> ''",
}
