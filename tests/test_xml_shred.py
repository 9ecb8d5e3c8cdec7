import xml.etree.ElementTree as ET

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ostraka.operators.xml_shred import KINDS, elements, entity_table, node_columns, repeated_children, shred
from ostraka.session import stored

DOC = '<t:div xmlns:t="u" type="edition"><!-- x --><ab>a<lb n="1"/>b <gap reason="lost" unit="line"/> c</ab><ab/></t:div>'


def brute(xml):
    out = []

    def walk(node, parent):
        out.append((len(out) + 1, parent, node.tag.rpartition("}")[2]))
        own = len(out)
        for child in node:
            walk(child, own)

    walk(ET.fromstring(xml), 0)
    return out


def rows_of(xml):
    columns = node_columns(xml)
    return None if columns is None else [(KINDS[k], *rest) for k, *rest in zip(*columns)]


names = st.sampled_from(["a", "b", "lb", "div"])
trees = st.recursive(st.builds(lambda n: f"<{n}/>", names), lambda inner: st.builds(lambda n, c: f"<{n}>x{''.join(c)}y</{n}>", names, st.lists(inner, max_size=4)), max_leaves=20)


@given(trees)
@settings(max_examples=60, deadline=None)
def test_numbers_match_a_recursive_walk(xml):
    assert [(n, p, t) for kind, n, p, _, t, _ in rows_of(xml) if kind == "element"] == brute(xml)


def test_malformed_values_give_nothing():
    for xml in ("<a><b></a>", "plain", "<a>&undefined;</a>", "<a"):
        assert rows_of(xml) is None


def test_nodes_keep_parent_ordinal_and_scalar():
    rows = rows_of(DOC)
    assert ("element", 2, 1, 1, "ab", "a b c") in rows
    assert ("element", 4, 2, 2, "gap", None) in rows
    assert ("attribute", None, 4, 1, "reason", "lost") in rows
    assert ("text", None, 2, 2, "text()", "b") in rows


def test_shredding_of_tables(spark):
    df = spark.createDataFrame([(1, DOC, "x"), (1, DOC, "y"), (2, None, None), (3, "", None), (4, "<a", None), (None, "<a/>", None)], "id int, xml string, tag string")
    rows = elements(shred(df, "xml", ["id"]), ["id"]).collect()
    assert sorted((r.id or 0, r.node_no, r.parent_no, r.tag) for r in rows) == sorted([(0, 1, 0, "a")] + 2 * [(1, 1, 0, "div"), (1, 2, 1, "ab"), (1, 3, 2, "lb"), (1, 4, 2, "gap"), (1, 5, 1, "ab")])
    assert shred(df.limit(0), "xml", ["id"]).count() == 0
    with pytest.raises(ValueError):
        elements(shred(df, "xml", ["tag"]), ["tag"])
    with pytest.raises(ValueError):
        shred(df.withColumnRenamed("tag", "label"), "xml", ["label"])


def test_entities_are_pivoted(spark):
    df = spark.createDataFrame([(1, DOC), (2, DOC.replace('unit="line"', ""))], "id int, xml string")
    gaps = entity_table(shred(df, "xml", ["id"]), "gap", {"reason": "@reason", "unit": "@unit"}, ["id"]).orderBy("id").collect()
    assert [(r.id, r.node_no, r.parent_no, r.reason, r.unit) for r in gaps] == [(1, 4, 2, "lost", "line"), (2, 4, 2, "lost", None)]
    blocks = entity_table(shred(df, "xml", ["id"]), "ab", {"text": "text()", "gap": "gap"}, ["id"]).orderBy("id", "node_no").collect()
    assert [(r.id, r.text) for r in blocks] == [(1, "a b c"), (1, None), (2, "a b c"), (2, None)]


def test_repeated_children_have_rows_of_their_own(spark):
    df = spark.createDataFrame([(1, "<div><p>one</p><p>two</p><head/><p>two</p></div>"), (2, "<div/>")], "id int, xml string")
    nodes = stored(shred(df, "xml", ["id"]), "nodes")
    rows = repeated_children(nodes, "div", ["p", "head"], ["id"]).orderBy("ordinal").collect()
    assert [(r.id, r.node_no, r.label, r.ordinal, r.scalar) for r in rows] == [(1, 1, "p", 1, "one"), (1, 1, "p", 2, "two"), (1, 1, "head", 3, None), (1, 1, "p", 4, "two")]
    assert [(r.id, r.p) for r in entity_table(nodes, "div", {"p": "p"}, ["id"]).orderBy("id").collect()] == [(1, "one"), (2, None)]
