import pytest

from ostraka.operators.render import FULLEST, Switches, edition_text, has_edition, transcription_language, transcription_snippet, translation_languages, translation_snippets, translation_text

LINES = (
    '<TEI><text><body><div type="edition" xml:lang="grc"><ab><lb n="1"/>α<unclear>β</unclear> γ<expan>δ<ex>ε</ex></expan> <supplied reason="lost">ζ</supplied>κ<choice><reg>θ</reg><orig>ι</orig></choice>'
    '<lb n="2"/>λ<supplied reason="omitted">ν</supplied><supplied reason="lost">μ</supplied></ab></div></body></text></TEI>'
)


def edition(inner):
    return f'<div type="edition"><ab>{inner}</ab></div>'


@pytest.mark.parametrize(("switches", "text"), [(Switches(), "α γδ κι\nλ"), (FULLEST, "αβ γδε ζκθ\nλμ"), (Switches(abbrev=True), "α γδε κι\nλ")])
def test_switches(switches, text):
    assert edition_text(LINES, switches) == text


@pytest.mark.parametrize(
    ("inner", "switches", "text"),
    [
        ("α<gap/>β", Switches(), "αβ"),
        ("α<gap/>β", Switches(break_on_gap=True), "α\nβ"),
        ("<choice><corr>a</corr><orig>b</orig><sic>c</sic></choice>", FULLEST, "b"),
        ("<choice><corr>a</corr><sic>c</sic></choice>", FULLEST, "a"),
        ("<choice><corr>a</corr><sic>c</sic></choice>", Switches(), "c"),
        ("<app><lem>x</lem><rdg>y</rdg></app>", FULLEST, "x"),
        ("<app><rdg>y</rdg><rdg>z</rdg></app>", FULLEST, "y"),
        ("<subst><add>x</add><del>y</del></subst>", FULLEST, "x"),
        ("<subst><del>y</del>z</subst>", FULLEST, "z"),
        ("a<note>n</note><!-- c -->b<space/>c<fw>f</fw>", FULLEST, "ab c"),
        ("a  \t b", FULLEST, "a b"),
        ("<lb/>a<lb break='no'/>b", FULLEST, "a\nb"),
    ],
)
def test_rules(inner, switches, text):
    assert edition_text(edition(inner), switches) == text


def test_a_line_mark_before_the_edition_counts():
    assert edition_text('<r><lb/><div type="edition">x<lb/>y</div></r>') == "x\ny"


def test_translations():
    xml = '<r><div type="translation" xml:lang="de"><p>Recto.<note>n</note></p><p>Verso.<milestone rend="break"/>Ende</p></div><div type="translation" xml:lang="en"><p>One <ex>two</ex></p></div></r>'
    assert translation_text(xml) == "Recto.\nVerso.\nEnde\n\nOne two"
    assert translation_text(xml, "en") == "One two"
    assert translation_text(xml, "fr") == ""
    assert translation_languages(xml) == ["de", "en"]
    assert [lang for lang, _ in translation_snippets(xml)] == ["de", "en"]


def test_languages_and_snippets():
    assert transcription_language(LINES) == "grc"
    assert transcription_language('<r xml:lang=" la "><div type="edition"/></r>') == "la"
    assert transcription_language("<r/>") is None
    assert transcription_snippet("<r/>") is None
    assert transcription_snippet('<r xmlns="u"><div type="edition"><ab>x</ab></div>tail</r>') == '<div type="edition"><ab>x</ab></div>'


@pytest.mark.parametrize(("xml", "there"), [('<r><div type="edition"><note>n</note><ab/></div></r>', False), (edition("x"), True), (edition("<gap/>"), True), ("<r><ab>x</ab></r>", False)])
def test_empty_editions(xml, there):
    assert has_edition(xml) is there


def test_every_stored_text_is_rendered_again(spark, data):
    from ostraka.plans.texts import render_text

    stored = {r.transcription_id: r.text for r in spark.read.parquet(f"{data}/transcriptions.parquet").select("transcription_id", "text").collect()}
    assert {r.transcription_id: r.rendered for r in render_text(spark, data).collect()} == stored
