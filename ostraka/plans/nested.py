"""Queries of problem 3: nested records to related flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ostraka.operators.xml_shred import elements, entity_table, repeated_children, shred
from ostraka.plans.retrieval import BLANKS
from ostraka.session import stored
from ostraka.sources.tables import table

KEYS = ["transcription_id"]


def _nodes(spark: SparkSession, root: str) -> DataFrame:
    return shred(table(spark, root, "transcriptions"), "xml_content", KEYS)


def _stored_nodes(spark: SparkSession, root: str) -> DataFrame:
    """The adjacency table, written once: objects and scalars are read from it, no record is parsed twice."""
    return stored(_nodes(spark, root), "nodes")


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return elements(_nodes(spark, root), KEYS)


def p3_gaps(spark: SparkSession, root: str) -> DataFrame:
    """Every gap with its reason, extent and unit."""
    return entity_table(_stored_nodes(spark, root), "gap", {"reason": "@reason", "quantity": "@quantity", "extent": "@extent", "unit": "@unit"}, KEYS)


def p3_textparts(spark: SparkSession, root: str) -> DataFrame:
    """Every division with its kind, number, language and heading."""
    return entity_table(_stored_nodes(spark, root), "div", {"type": "@type", "subtype": "@subtype", "n": "@n", "lang": "@lang", "head": "head"}, KEYS)


def p3_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    """Every paragraph and block of a division, in order, with the text that stands in it directly."""
    return repeated_children(_stored_nodes(spark, root), "div", ["p", "ab", "head"], KEYS)


def p3_node_profile(spark: SparkSession, root: str) -> DataFrame:
    """Nodes of each kind and label: how often, in how many records, how many with a scalar."""
    return _nodes(spark, root).groupBy("kind", "label").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_distinct("transcription_id").alias("records"),
        F.count("scalar").alias("with_scalar"),
    )


# Tags and texts in order, told apart by patterns; records whose tags don't balance are left out. e has the elements, x
# their attributes, f the pieces of text that stand in them directly.
_VALUE = r"""replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&')"""
NODES = rf"""
WITH RECURSIVE y AS (SELECT transcription_id, regexp_extract_all(regexp_replace(xml_content, '<!--.*?-->|<\?.*?\?>|<![^>]*>', '', 'gs'), '<[^>]*>|[^<]+') AS tokens FROM transcriptions),
t AS (SELECT transcription_id, unnest(tokens) AS tag, generate_subscripts(tokens, 1) AS i FROM y),
k AS (SELECT *, starts_with(tag, '</') AS closing, ends_with(tag, '/>') AS alone, starts_with(tag, '<') AS mark, CASE WHEN starts_with(tag, '</') THEN -1 WHEN ends_with(tag, '/>') OR NOT starts_with(tag, '<') THEN 0 ELSE 1 END AS step FROM t),
d AS (SELECT *, sum(step) OVER (PARTITION BY transcription_id ORDER BY i) AS level, sum(step) OVER (PARTITION BY transcription_id) AS balance FROM k),
n AS (SELECT transcription_id, tag, i, alone, (level + CASE WHEN alone THEN 1 ELSE 0 END)::INTEGER AS depth, row_number() OVER (PARTITION BY transcription_id ORDER BY i)::INTEGER AS node_no FROM d WHERE mark AND NOT closing AND balance = 0),
e AS (SELECT c.transcription_id, c.node_no, coalesce(p.node_no, 0)::INTEGER AS parent_no, regexp_extract(c.tag, '^<(?:[^\s/>:]+:)?([^\s/>]+)', 1) AS label, c.tag, row_number() OVER (PARTITION BY c.transcription_id, p.node_no ORDER BY c.node_no)::INTEGER AS ordinal
  FROM n c ASOF LEFT JOIN n p ON c.transcription_id = p.transcription_id AND c.depth - 1 = p.depth AND c.node_no > p.node_no),
x AS (SELECT transcription_id, node_no, regexp_extract(a, '^(?:[^\s=:]+:)?([^\s=:]+)', 1) AS label, starts_with(a, 'xmlns') AS declares, {_VALUE.format(r"regexp_extract(a, '=\s*.(.*).$', 1, 's')")} AS scalar
  FROM (SELECT transcription_id, node_no, unnest(regexp_extract_all(tag, '[^\s=<>/]+\s*=\s*(?:"[^"]*"|''[^'']*'')')) AS a FROM e)),
f AS (SELECT o.transcription_id, p.node_no, o.i, trim(regexp_replace({_VALUE.format('o.tag')}, '{BLANKS}', ' ', 'g')) AS piece FROM (SELECT * FROM d WHERE NOT mark AND balance = 0) o
  ASOF JOIN (SELECT * FROM n WHERE NOT alone) p ON o.transcription_id = p.transcription_id AND o.level = p.depth AND o.i > p.i),
g AS (SELECT transcription_id, node_no, string_agg(piece, ' ' ORDER BY i) AS scalar FROM f WHERE piece <> '' GROUP BY ALL)"""


def _attributes(**names: str) -> str:
    """The attributes of an element e as columns."""
    return ", ".join(f"(SELECT max(scalar) FROM x WHERE x.transcription_id = e.transcription_id AND x.node_no = e.node_no AND x.label = '{label}') AS \"{name}\"" for name, label in names.items())


SQL = {
    "p3_found": NODES + " SELECT transcription_id, node_no, parent_no, label AS tag FROM e",
    "p3_gaps": f"{NODES} SELECT transcription_id, node_no, parent_no, ordinal, {_attributes(reason='reason', quantity='quantity', extent='extent', unit='unit')} FROM e WHERE label = 'gap'",
    "p3_textparts": f"""{NODES}, h AS (SELECT e.transcription_id, parent_no, scalar FROM e LEFT JOIN g USING (transcription_id, node_no) WHERE label = 'head' QUALIFY row_number() OVER (PARTITION BY e.transcription_id, parent_no ORDER BY ordinal) = 1)
        SELECT e.transcription_id, node_no, e.parent_no, ordinal, {_attributes(type='type', subtype='subtype', n='n', lang='lang')}, h.scalar AS head FROM e LEFT JOIN h ON h.transcription_id = e.transcription_id AND h.parent_no = e.node_no WHERE label = 'div'""",
    "p3_paragraphs": f"""{NODES} SELECT c.transcription_id, p.node_no, c.label, c.ordinal, g.scalar FROM e c JOIN e p ON c.transcription_id = p.transcription_id AND c.parent_no = p.node_no
        LEFT JOIN g ON g.transcription_id = c.transcription_id AND g.node_no = c.node_no WHERE p.label = 'div' AND c.label IN ('p', 'ab', 'head')""",
    "p3_node_profile": f"""{NODES} SELECT 'element' AS kind, label, count(*) AS nodes, count(DISTINCT transcription_id) AS records, count(scalar) AS with_scalar FROM e LEFT JOIN g USING (transcription_id, node_no) GROUP BY label
        UNION ALL SELECT 'attribute', label, count(*), count(DISTINCT transcription_id), count(*) FROM x GROUP BY label UNION ALL SELECT 'text', 'text()', count(*), count(DISTINCT transcription_id), count(*) FROM f WHERE piece <> ''""",
}
QUERIES = {"p3_found": p3_found, "p3_gaps": p3_gaps, "p3_textparts": p3_textparts, "p3_paragraphs": p3_paragraphs, "p3_node_profile": p3_node_profile}
