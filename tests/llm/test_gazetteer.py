import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ostraka.llm import gazetteer as g


def edits(a, b):
    """Edit distance with swaps of neighbours."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            n = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                n = min(n, before[j - 2] + 1)
            now.append(n)
        before, last = last, now
    return last[-1]


ENTRIES = [
    g.Entry(1, "settlement", "N1", ("Hiearbus", "Hiearbos", "Χιεάρβος", "Kom Nukadal")),
    g.Entry(2, "settlement", "N2", ("Hiearbus", "Hiearbos - Hiearbus", "Χιεάρβος")),
    g.Entry(3, "settlement", "N1", ("Emsazai", "Εμσαζάι", "Gezirat Tabinuktab")),
    g.Entry(4, "nome", "N1", ("Nauphrites", "Ναυφρίτες")),
    g.Entry(5, "nome", "N2", ("Gorsenites", "Γορσενίτες")),
    g.Entry(6, "settlement", "N2", ("Bus", "Βους")),
]
BOOK = g.Gazetteer(ENTRIES)


@given(st.text("abc", max_size=7), st.lists(st.text("abc", min_size=1, max_size=7), max_size=12), st.integers(0, 2))
@settings(max_examples=300, deadline=None)
def test_the_automaton_finds_what_edit_distance_finds(word, names, most):
    trie = g.Trie()
    for name in names:
        trie.add(name, name)
    assert trie.near(word, most) == {n: edits(word, n) for n in names if edits(word, n) <= most}


@pytest.mark.parametrize(
    ("place", "full", "entry"),
    [
        ("Emsazai", "Emsazai", 3), ("Emsazai (?)", "Emsazai (?)", 3), ("near Emsazai", "Nauphrites: near Emsazai", 3), ("[Em]sazai", "[Em]sazai, Nauphrites", 3), ("Ems...ai", "Ems...ai", 3),
        ("Emsaz.", "Emsaz.", 3), ("Emszaai", "Emszaai", 3), ("ΕΜΣΑΖΑΙ", "ΕΜΣΑΖΑΙ", 3), ("ⲉⲙⲥⲁⲍⲁⲓ", "ⲉⲙⲥⲁⲍⲁⲓ", 3), ("mod. Gezirat el-Tabinuktab", "x", 3), ("the same village", "Nauphrites, Emsazai (?)", 3),
        ("Em sazai", "Em sazai", 3), ("Hiearbos", "Hiearbos (Nauphrites, Egypt)", 1), ("Hiearbos", "Gorsenetes, Hiearbos (?)", 2), ("Hiearbos", "Hiearbos", -1), ("Hiearbos", "Hiearbos (Γορσενίτες)", 2),
        ("Nauphrites", "Egypt, Nauphrites", 4), ("near Gorsenites", "Gorsenites", 5), ("Unheard", "Unheard (Nauphrites)", -1), ("?", "?", -1), ("", None, -1), (None, None, -1), ("Egypt (?)", "Egypt (?)", -1),
        ("Bus", "Bus", 6), ("Bas", "Bas", -1), ("[...]", "[...]", -1),
    ],
)
def test_names(place, full, entry):
    assert BOOK.resolve(place, full)[0] == entry


def test_tables(spark):
    df = spark.createDataFrame([(1, "Emsazai", "Emsazai", 9), (1, "Emsazai", "Emsazai", 9), (2, None, None, None), (None, "x" * 5000, "y", 1)], "id int, p string, f string, edits int")
    got = sorted(((r.id or 0), r.geo_id) for r in g.map_places(df, "id", "p", "f", ENTRIES).collect())
    assert got == [(0, -1), (1, 3), (1, 3), (2, -1)]
    assert g.map_places(df.limit(0), "id", "p", "f", ENTRIES).count() == 0
    assert g.map_places(df, "id", "p", "f", []).filter("geo_id = -1").count() == 4
    with pytest.raises(ValueError):
        g.map_places(df, "edits", "p", "f", ENTRIES)
    near = {(r.p, r.geo_id): r.edits for r in g.entries_within(df, "p", ENTRIES).collect()}
    assert near == {("Emsazai", 3): 0}
    assert BOOK.within("Hiearbus") == {1: 0, 2: 0} and BOOK.within("Hiearbes") == {1: 1, 2: 1} and BOOK.within(None) == {}
    with pytest.raises(ValueError):
        g.map_places(df, "id", "p", "f", [g.Entry(1, "settlement", None, ("x",) * (g.LIST_NAMES + 1))])
    geo = spark.createDataFrame([(7, "settlement", "N1", "A - B", None, "", None, None, " ")], "id int, status string, nomos_code string, name_latin string, name_standard string, unicode_greek string, unicode_egyptian string, unicode_coptic string, location string")
    assert g.entries_of(geo) == [g.Entry(7, "settlement", "N1", ("A - B",))]


def test_linked_rows_are_found_again(spark, data):
    """Rows that carry a reference: their names must lead to it wherever they can be told apart."""
    entries = g.entries_of(spark.read.parquet(f"{data}/export_geo.parquet"))
    rows = spark.read.parquet(f"{data}/orig_places.parquet").join(spark.read.parquet(f"{data}/export_geo.parquet").select(F.col("id").alias("tm_place_id")), "tm_place_id", "left_semi")
    found = g.map_places(rows, "place_id", "place_name", "full_place_name", entries).join(rows, "place_id").filter(f"geo_id <> {g.NO_ENTRY}").select("geo_id", "tm_place_id").collect()
    assert len(found) > 40 and sum(r.geo_id == r.tm_place_id for r in found) >= 0.98 * len(found)
