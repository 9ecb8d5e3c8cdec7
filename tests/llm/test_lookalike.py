import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ostraka.llm.lookalike import CLASSES, SCRIPTS, canonical, lookalike_classes, lookalike_forms, lookalike_pairs

TEXTS = [
    "Before three witnesses the elder Apollonios wrote to me, and said: no!\nOXO",
    "ἐπὶ τριῶν μαρτύρων ὁ γείτων ἡμῶν Νυσενεσόνες ἔπεμψεν πρὸς τὴν μητέρα·\nβʹ ἐφ’ ᾧ",
    "ⲛⲭⲟⲣⲧⲟⲥ ⲙⲡϥⲟⲩⲱϣ ⲉϯ ⲟⲥⲟ",
    "Überführung für ſich, señor",
]
INVISIBLE = "­​‌‍⁠﻿‎͏︎"
BLANK = "       　"


def disguised(text, seed):
    rng = random.Random(seed)
    out = []
    for c in text:
        if c in CLASSES and rng.random() < 0.5:
            # another script's letter of the same shape, so long as the token keeps a letter of its own
            c = rng.choice(list(CLASSES[c].values()))
        elif c == " ":
            c = rng.choice(BLANK)
        elif "!" <= c <= "~" and rng.random() < 0.2:
            c = chr(ord(c) + 0xFEE0)
        elif c == "’":
            c = rng.choice("ʼ᾽’")
        elif rng.random() < 0.3:
            c = unicodedata.normalize("NFD", c)
        out.append(c)
        if rng.random() < 0.1 and c != "\n":
            out.append(rng.choice(INVISIBLE))
    return "".join(out)


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("seed", range(8))
def test_disguises_have_one_form(text, seed):
    assert canonical(disguised(text, seed)) == canonical(text)


@given(st.text(st.sampled_from("aаοoООΑAАvν·.;1 \nбяλẃ​ ﬁ"), max_size=25))
@settings(max_examples=300, deadline=None)
def test_a_form_is_its_own_form(text):
    once = canonical(text)
    assert canonical(once) == once


@pytest.mark.parametrize(("a", "b"), [("word", "Word"), ("ὁ", "ὀ"), ("e", "é"), ("a b", "a\nb"), ("a.", "a"), ("a b", "ab"), ("’", "'"), ("n", "ν")])
def test_visible_differences_stay(a, b):
    assert canonical(a) != canonical(b)


@pytest.mark.parametrize(("given_text", "form"), [("Αpοlιnax", None), ("сасо in a text", "caco in a text"), ("Тhе", "The"), ("ТΟΥΣ λόγους", "ΤΟΥΣ λόγους"), ("ＡＢ１", "AB1"), ("ﬁn", "fin"), ("a b", "a b"), ("a\r\nb", "a\nb"), ("", "")])
def test_spellings(given_text, form):
    if form is not None:
        assert canonical(given_text) == form


def test_classes_are_disjoint():
    assert all(set(members) <= set(SCRIPTS) and c in members.values() for c, members in CLASSES.items())


def found(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, text string, lemma string, form string")
    pairs = lookalike_pairs(lookalike_forms(df, "id", ["text", "lemma"]))
    return sorted(map(tuple, pairs.select("field_name", "id_a", "id_b").collect()))


def test_pairs_of_rows(spark):
    rows = [(1, "a b", None, "x"), (2, "a b", "q", "y"), (3, "a b", "q​", None), (4, "a  b", "", "z"), (5, None, "​", "z")]
    assert found(spark, rows) == [("lemma", 2, 3), ("lemma", 4, 5), ("text", 1, 2), ("text", 2, 3)]
    assert found(spark, []) == []


def test_pairs_match_brute_force_with_a_hot_group(spark):
    variants = ["o", "ο", "о", "o​"]
    rows = [(i, "o" if i < 40 else variants[i % 4], None, None) for i in range(60)]
    want = sorted(("text", i, j) for i in range(60) for j in range(i + 1, 60) if rows[i][1] != rows[j][1])
    assert found(spark, rows) == want


def test_classes_and_links_match_the_pairs(spark):
    variants = ["o", "ο", "о", "o​", "q"]
    rows = [(i, "o" if i < 20 else variants[i % 5], "x" if i % 7 else None, None) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, text string, lemma string, form string")
    forms = lookalike_forms(df, "id", ["text", "lemma"])
    links = {}
    for field, a, b in found(spark, rows):
        links[field, a] = links.get((field, a), 0) + 1
        links[field, b] = links.get((field, b), 0) + 1
    got = {(r.field_name, r.id): r.links for r in lookalike_classes(forms).collect()}
    assert got == {(f, i): links.get((f, i), 0) for i, text, lemma, _ in rows for f, v in (("text", text), ("lemma", lemma)) if v is not None}
    assert {r.class_id for r in lookalike_classes(forms).filter("field_name = 'lemma'").collect()} == {1}


@pytest.mark.parametrize(("a", "b"), [("κῆπος", "кῆπος"), ("բառ ոսկի օր", "բառ nuկի oր"), ("ӏӏама", "llама")])
def test_further_scripts(a, b):
    assert canonical(a) == canonical(b)
