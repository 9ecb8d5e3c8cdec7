import pytest
from pyspark.sql import functions as F

from ostraka.llm import language as lg

EN = ["The widow sold the white donkey to the farmer from the village.", "Nobody has brought a complaint about the rent of the olive grove.", "The steward measured the wheat into the granary before three witnesses.", "I have signed for him because he cannot write his own name."]
DE = ["Die Witwe hat dem Bauern aus dem Dorf den weißen Esel verkauft.", "Niemand hat eine Klage über die Pacht für den Ölgarten erhoben.", "Der Verwalter hat den Weizen vor drei Zeugen in den Speicher gemessen.", "Ich habe für ihn unterschrieben, weil er nicht schreiben kann."]
GRC = ["ἡ χήρα πέπρακεν τῷ γεωργῷ ἐκ τῆς κώμης τὸν ὄνον τὸν λευκόν.", "οὐδεὶς ἐνεκάλεσεν περὶ τοῦ φόρου τοῦ ἐλαιῶνος ἐν τῇ κώμῃ."]
COP = ["ⲧⲉⲭⲏⲣⲁ ⲁⲥϯ ⲉⲃⲟⲗ ⲙⲡⲟⲩⲟⲉⲓⲉ ϩⲙ ⲡϯⲙⲉ ⲙⲡⲉⲓⲱ ⲛⲟⲩⲱⲃϣ.", "ⲙⲡⲉ ⲗⲁⲁⲩ ⲉⲅⲕⲁⲗⲉⲓ ϩⲁ ⲡⲡⲁⲕⲧⲟⲛ ⲙⲡⲙⲁ ⲛϫⲟⲉⲓⲧ."]


@pytest.fixture(scope="module")
def model():
    labelled = [(c, " ".join(s[i:] + s[:i])) for c, s in (("en", EN), ("de", DE), ("grc", GRC), ("cop", COP)) for i in range(len(s))]
    return lg.fit_texts(labelled + [("en", " ".join(DE))])


def test_sentences_cover_the_text():
    text = ' One two. "Three?" four; five\n\nsix· seven'
    assert "".join(text[a:b] for a, b in lg.sentences(text)) == text
    assert lg.sentences(" \n ") == [] and lg.sentences("") == []


def test_sentences_find_their_language(model):
    found = model.classify(["The farmer sold the wheat to the widow before three witnesses.", "Der Bauer hat der Witwe den Weizen vor drei Zeugen verkauft.", GRC[1], COP[1], "Too short.", "", "1234 5678 9012 3456 7890 !!"])
    assert [f and f[0] for f in found] == ["en", "de", "grc", "cop", None, None, None]


def test_capitals_and_lost_accents_don_t_matter(model):
    found = model.classify([DE[1].upper(), "Niemand hat eine Klage uber die Pacht fur den Olgarten erhoben."])
    assert [f[0] for f in found] == ["de", "de"]


def rows(spark, values):
    return spark.createDataFrame(values, "id int, text string, lang string, start_text string")


def test_segments_and_labels(spark, model):
    mixed = f"{EN[0]} {EN[1]}\n\n{DE[1]}"
    quoted = "The expression ἐν τῇ κώμῃ is also found in the complaint about the rent of the olive grove."
    df = rows(spark, [(1, mixed, "en", "x"), (2, EN[2], "de", None), (3, EN[2], "English", None), (4, DE[0], None, None), (5, quoted, "en", None), (6, None, "en", None), (7, "", None, None), (8, GRC[0], "el", None), (8, GRC[0], "el", None), (9, DE[0], "??", None)])
    segments = lg.language_segments(df, ["id", "lang"], "text", model)
    first = [(r.segment_no, r.lang_code, mixed[r.start : r.end].strip()) for r in segments.filter("id = 1").orderBy("segment_no").collect()]
    assert first == [(1, "en", f"{EN[0]} {EN[1]}"), (2, "de", DE[1])]
    assert all(0 <= r.confidence <= 1 for r in segments.collect())
    languages = lg.document_languages(segments, ["id", "lang"])
    assert [r.lang_code for r in languages.filter("id = 1 and main").collect()] == ["en"]
    wrong = sorted(map(tuple, lg.doubtful_labels(languages, ["id", "lang"], "lang").select("id", "lang_code").collect()))
    assert wrong == [(1, "de"), (1, "en"), (2, "en"), (4, "de"), (9, "de")]
    assert {r.lang_code for r in segments.filter("id in (6, 7)").collect()} == {lg.UNDECIDED}
    assert lg.language_segments(df.limit(0), ["id"], "text", model).count() == 0
    with pytest.raises(ValueError):
        lg.language_segments(df.withColumnRenamed("start_text", "start"), ["start"], "text", model)


def test_fit_from_a_table_is_bounded(spark):
    df = rows(spark, [(i, s, c, None) for i, (c, s) in enumerate([("en", x) for x in EN] + [("German", x) for x in DE] + [(None, EN[0]), ("xx", "")])])
    model = lg.fit(df, "id", "text", "lang", sample_rows=3)
    assert {c for c, _ in model.contents} == {"en", "de"}
    assert df.filter(F.col("lang").isNotNull()).count() == 9
    assert lg.fit(df.limit(0), "id", "text", "lang").contents == ()
    assert lg.fit(df.limit(0), "id", "text", "lang").classify([EN[0]]) == [None]


def test_held_out_accuracy(spark, data):
    """On rows that weren't sampled the language found is that of the label, but for planted wrong labels."""
    d = spark.read.parquet(f"{data}/documents.parquet")
    model = lg.fit(d, "doc_id", "text", "lang", sample_rows=12)
    found = lg.document_languages(lg.language_segments(d, ["doc_id", "lang"], "text", model), ["doc_id", "lang"]).filter("main")
    named = found.withColumn("code", lg.language_code(F.col("lang"))).filter("code is not null").collect()
    assert sum(r.code == r.lang_code for r in named) >= 0.8 * len(named)


def test_narrow_margins_are_rejected():
    same = " ".join(EN).lower().encode()
    twins = lg.LanguageModel((("en", same), ("de", same)))
    spans = [(0, len(EN[0]))]
    assert [(c, n) for _, _, c, _, n in lg.segments_of(EN[0], spans, twins.classify([EN[0]]))] == [("en", 0)]
    assert twins.classify([EN[0]])[0][1] < lg.MARGIN


def test_short_texts_are_told_as_a_whole(spark, model):
    df = rows(spark, [(1, "Die Witwe hat verkauft.", None, None), (2, "The widow. The steward.", None, None), (3, "12.", None, None)])
    got = {r.id: (r.lang_code, r.sentences, r.confidence < 0.2) for r in lg.language_segments(df, ["id"], "text", model).collect()}
    assert got == {1: ("de", 0, True), 2: ("en", 0, True), 3: (lg.UNDECIDED, 0, True)}
