import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ostraka.functions import dates, languages, text
from ostraka.operators import embeddings, evaluate, images, lemmas, profile, search
from ostraka.sources import corpus, dumps


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(make(F.col("v")).alias("x"), "i").orderBy("i").select("x").collect()]


def test_chunks(spark):
    words = lambda n: " ".join(map(str, range(n)))
    found = column(spark, [f"  {words(10)}\n", words(11), words(16), words(19), None, ""], "string", lambda c: text.word_chunks(c, 10))
    assert found[0] == [f"  {words(10)}\n"]
    assert [len(x) for x in found[1:4]] == [2, 2, 2]
    assert found[2][1].split()[0] == "9" and found[3][1].split() == [str(i) for i in range(9, 19)]
    with pytest.raises(ValueError):
        text.word_chunks(F.col("v"), 0)


def test_sentences():
    assert text.sentence_chunks_of("First sentence. Second sentence!\nThird sentence") == ["First sentence.", "Second sentence!", "Third sentence"]
    assert [len(x.split()) for x in text.sentence_chunks_of(" ".join(["w"] * 105))] == [50, 50, 5]
    assert text.sentence_chunks_of("") == []
    with pytest.raises(ValueError):
        text.sentence_chunks_of("a", 0)


def test_languages(spark):
    tags = ["grc", "el-Grek", "la", "LAT", "cop_Egyp", "en", None, " "]
    assert column(spark, tags, "string", text.normalize_language) == ["grc", "grc", "lat", "lat", "cop", None, None, None]
    assert column(spark, tags, "string", text.language_label) == ["greek", "greek", "latin", "latin", "coptic", "en", "unknown", "unknown"]
    assert column(spark, ["en-GB", "English", "xx", None], "string", languages.language_code) == ["en", "en", None, None]
    assert [languages.code_of(t) for t in ("el", "ger", "", None)] == ["grc", "de", None, None]
    xmls = ["<div type='edition' xml:lang='grc'/>", '<!-- a --><TEI xml:lang="la"><div type="edition"><ab/>', "<a/>", "<div xml:lang='en' type='edition", None]
    assert column(spark, xmls, "string", languages.edition_language) == ["grc", "la", None, "en", None]


def test_text_functions(spark):
    assert column(spark, ["53", "1234", "123456"], "string", text.partition_name) == ["0", "1", "123"]
    assert column(spark, ["A - B;C", ""], "string", text.split_variants) == [["A - B;C", "A", "B;C", "A - B", "C"], []]
    assert column(spark, ["https://papyri.info/biblio/3", "https://doi.org/1", "DOI:9", "https://www.x.org/a", "ftp://x.org", "#a", "zz", None], "string", text.target_kind) == ["papyri.info/biblio", "doi", "doi", "x.org", "other", "local_fragment", "other", None]
    assert column(spark, [" ﬁ  A ", None], "string", text.normalize_lookup) == ["fi a", None]
    assert column(spark, ["abcd", "é"], "string", text.estimated_tokens) == [2, 1]
    odd = ["a\x1cb\x85 c\u3000", "\x1f", "\u200b", None]
    assert column(spark, odd, "string", text.words) == [v and v.split() for v in odd] and column(spark, odd, "string", text.stripped) == [v and v.strip() for v in odd]
    assert column(spark, odd, "string", text.not_blank) == [True, False, True, None]
    assert column(spark, ["λόγος, Ab12", ""], "string", text.lexemes) == [["λόγος", "ab12"], []]


def test_dates(spark):
    values = ["0582-01-09", "-0075", "0000", "0100-13", "0100-01-40", "0300-02-30", "300", None, "1900-02-29", "2000-02-29", "-0001-02-29"]
    found = column(spark, values, "string", lambda c: dates.parse_date(c, gregorian=True))
    assert [None if r is None else r.status for r in found] == ["valid", "valid", "year_zero", "invalid_month", "invalid_day", "invalid_gregorian_day", "invalid_lexical", None, "invalid_gregorian_day", "valid", "valid"]
    rows = spark.createDataFrame([(-10, 10), (None, 5), (200, None), (None, None), (101, 101)], "s int, e int")
    got = rows.select(dates.overlaps(F.col("s"), F.col("e"), 5, 101), dates.year_width(F.col("s"), F.col("e")), dates.width_bucket(F.col("s"), F.col("e"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, True]
    assert [r[1] for r in got] == [20, None, None, None, 1]
    assert [r[2] for r in got] == ["11-50", "open", "open", "text_only", "1"]
    with pytest.raises(Exception, match="not a date"):
        rows.select(dates.strict_parts(F.lit("soon"))).collect()


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (2, "a a c", 2), (3, "", 1), (4, None, 1), (5, "c", 2)], "transcription_id bigint, text string, tm_id bigint")
    found = {r.transcription_id: r.score for r in search.bm25_scores(docs, "transcription_id", "text", "A a").collect()}
    n, avg, idf = 4, 6 / 4, math.log(1 + (4 - 2 + 0.5) / 2.5)
    score = lambda tf, length: idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / avg))
    assert found == pytest.approx({1: score(1, 2), 2: score(2, 3)}) and n == 4
    best = search.bm25_search(docs, query_text="a", limit=1, columns=("tm_id",)).collect()
    assert [r.transcription_id for r in best] == [2]
    assert search.bm25_search(docs, query_text="a", limit=0, columns=("tm_id",)).count() == 0
    assert search.bm25_search(docs, query_text="zzz", limit=5, columns=("tm_id",)).count() == 0
    with pytest.raises(ValueError):
        search.bm25_search(docs, query_text="a", limit=-1)
    places = {"orig_places": spark.createDataFrame([(1, 9)], "tm_id int, tm_place_id int")}
    only = search.bm25_search(docs, query_text="a", limit=5, metadata_filter=search.MetadataFilter(tm_place_ids=(9,)), metadata=places, columns=("tm_id",)).collect()
    assert [(r.transcription_id, round(r.score, 6)) for r in only] == [(1, round(math.log(1 + 1.5 / 1.5) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / 1)), 6))]


def test_interval_filters_are_row_local(spark):
    docs = spark.createDataFrame([(i, "a", i) for i in range(1, 6)], "transcription_id bigint, text string, tm_id bigint")
    rows = [(1, None, 100, False), (2, 300, None, False), (3, 100, 200, True), (4, 10, 20, False), (4, 400, 500, False), (5, 150, 150, False)]
    meta = {"orig_dates": spark.createDataFrame(rows, "tm_id bigint, not_before_year int, not_after_year int, alternative boolean")}
    wanted = search.MetadataFilter(not_before_year=100, not_after_year=200)
    assert sorted(r.tm_id for r in search.filtered(docs, wanted, meta).collect()) == [1, 5]


@pytest.mark.parametrize("bad", [{"material": " "}, {"not_before_year": 5, "not_after_year": 4}, {"keywords": ("",)}, {"tm_place_ids": (0,)}])
def test_filters_are_checked(bad):
    with pytest.raises(ValueError):
        search.MetadataFilter(**bad)


def stored_rows(spark, rows):
    return spark.createDataFrame([(x, m, c, "p", "1", None, t, t, [1.0, 0.0], None) for x, m, c, t in rows], "xml_id bigint, model_name string, chunk_index int, source_path string, tm_id string, language string, document_text string, input_hash string, embedding array<float>, updated_at timestamp")


def test_refresh(spark):
    docs = spark.createDataFrame([(1, "p", 1, "one"), (2, "p", 1, "long text"), (3, "p", 1, " ")], "transcription_id bigint, source_path string, tm_id bigint, text string")
    chunks = embeddings.document_chunks(docs, "m", F.lit(None).cast("string"), 1)
    assert sorted((r.xml_id, r.chunk_index, r.document_text) for r in chunks.collect()) == [(1, 0, "one"), (2, 0, "long"), (2, 1, "text")]
    old = stored_rows(spark, [(1, "m", 0, "x"), (1, "m", 1, "y"), (9, "m", 0, "z"), (9, "other", 0, "z")])
    after, work = embeddings.refreshed(old, chunks, "m", embeddings.hash_embedder(4))
    assert sorted((r.xml_id, r.model_name, r.chunk_index, r.document_text) for r in after.collect()) == [(1, "m", 0, "one"), (2, "m", 0, "long"), (2, "m", 1, "text"), (9, "other", 0, "z")]
    assert work.count() == 3
    again, none = embeddings.refreshed(after, chunks, "m", embeddings.hash_embedder(4))
    assert none.count() == 0 and again.count() == 4
    skipping, _ = embeddings.refreshed(old, chunks, "m", lambda texts: [None] * len(texts))
    assert sorted((r.xml_id, r.chunk_index, r.document_text) for r in skipping.filter("model_name = 'm'").collect()) == [(1, 0, "x")]
    assert embeddings.missing_sources(old, chunks.limit(0), "m").count() == 3


def test_vectors_are_checked(spark):
    chunks = embeddings.document_chunks(spark.createDataFrame([(1, "p", 1, "one")], "transcription_id bigint, source_path string, tm_id bigint, text string"), "m", F.lit("en"))
    with pytest.raises(Exception, match="finite"):
        embeddings.embedded(chunks, lambda texts: [[float("nan")] for _ in texts]).collect()


def vectors(spark, rows):
    return spark.createDataFrame([("m", t, f"p{t}", "grc", x, c, [float(a) for a in v]) for t, x, c, v in rows], "model_name string, tm_id string, source_path string, language string, xml_id bigint, chunk_index int, embedding array<float>")


@pytest.mark.parametrize("block", [2, 100])
def test_ranks_match_brute_force(spark, block):
    rng = np.random.default_rng(5)
    a = [(str(t), t, c, rng.normal(size=4)) for t in range(8) for c in range(1 + t % 3)] + [("z", 90, 0, np.zeros(4))]
    b = [(str(t), 100 + t, c, rng.normal(size=4)) for t in range(9) for c in range(1 + t % 2)] + [("10", 200, 0, np.zeros(4)), ("z", 201, 0, [1, 0, 0, 0])]
    unit = lambda v: v / np.linalg.norm(v) if np.linalg.norm(v) else v * np.nan
    best = lambda q, c: np.nanmin([np.inf] + [1 - unit(np.float32(x)).astype(float) @ unit(np.float32(y)).astype(float) for tq, _, _, x in a if tq == q for tc, _, _, y in b if tc == c])
    want = {}
    for q in {t for t, *_ in a}:
        order = sorted((round(best(q, c), 6), c) for c in {t for t, *_ in b})
        want[q] = [c for _, c in order].index(q) + 1
    found = {r.tm_id: r["rank"] for r in evaluate.target_ranks(vectors(spark, a), vectors(spark, b), block).collect()}
    for split in (1, 2):  # hot records are dealt in parts, on both sides
        parted = evaluate.target_ranks(vectors(spark, a), vectors(spark, b), block, split)
        assert {r.tm_id: r["rank"] for r in parted.collect()} == found
        assert {r.tm_id: [n.tm_id for n in r.nearest] for r in parted.collect() if r.tm_id != "z"} == {r.tm_id: [n.tm_id for n in r.nearest] for r in evaluate.target_ranks(vectors(spark, a), vectors(spark, b), block).collect() if r.tm_id != "z"}
    assert {k: v for k, v in found.items() if k != "z"} == {k: v for k, v in want.items() if k != "z"}


def test_measures(spark):
    ranks = spark.createDataFrame([("m", "1", 1, "greek", "1 chunk"), ("m", "2", 2, "greek", "2-3 chunks"), ("m", "3", 6, "coptic", "1 chunk"), ("m", "4", None, "coptic", "1 chunk")], "model_name string, tm_id string, rank int, language_label string, chunk_group string")
    rows = {(r.slice_kind, r.slice_value): r for r in evaluate.retrieval_measures(ranks).collect()}
    total = rows["total", "all"]
    assert (total.queries, total.recall_1, total.recall_5, total.mrr) == (4, 0.25, 0.5, pytest.approx((1 + 0.5 + 1 / 6) / 4))
    assert rows["language", "greek"].mrr == 0.75 and rows["chunks", "1 chunk"].queries == 3
    assert "| m | all | 4 |" in evaluate.Evaluation(list(rows.values())).to_markdown()


def test_lemmas(spark):
    df = spark.createDataFrame([(1, "Alpha beta.", None, "la"), (2, "X", "kept", "la"), (3, "Y", None, "en"), (4, None, None, "la")], "id int, text string, lemma_text string, language string")
    found = {r.id: r.lemma_text for r in lemmas.lemmatized(df, F.col("language")).collect()}
    assert found == {1: "alpha beta", 2: "kept", 3: None, 4: None}


def test_profiles(spark):
    docs = spark.createDataFrame([(1, '<a x="1"><b/><b/></a>'), (2, "<a/>"), (3, "<a")], "id int, xml string")
    items = profile.element_inventory(docs, "id", "xml")
    rows = {(r.kind, r.path): (r.documents, r.occurrences, r.min_per_document, r.max_per_document) for r in profile.frequency(items, "id", ["kind", "path"], F.col("times")).collect()}
    assert rows["element", "/a"] == (2, 2, 1, 1) and rows["element", "/a/b"] == (1, 2, 2, 2) and rows["error", ""] == (1, 1, 1, 1)
    names = profile.gazetteer_names(spark.createDataFrame([(1, "A - B"), (2, "B"), (3, None)], "id int, name string"), ["name"])
    found = {r.label: (r.status, r.geo_id) for r in profile.label_matches(spark.createDataFrame([("a",), ("B ",), ("c",), (None,)], "label string"), "label", names).collect()}
    assert found == {"a": ("single", 1), "B ": ("ambiguous", None), "c": ("none", None)}
    counts = profile.cardinality_histogram(docs, spark.createDataFrame([(1,), (1,), (2,)], "id int"), "id")
    assert {r["items"]: r.documents for r in counts.collect()} == {2: 1, 1: 1, 0: 1}


def test_images(spark):
    urls = ["https://doi.org/1", "http://doi.org/1", "https://quod.lib.umich.edu/a/apis/x-12", "https://example.org/", None, "no url"]
    assert column(spark, urls, "string", images.responsible_handler) == ["DOI", None, "UMichigan", None, None, None]
    links = spark.createDataFrame([("1", "https://doi.org/a"), ("2", "https://doi.org/b"), ("3", "https://doi.org/c"), ("4", "https://x.org/")], "tm_id string, url string")
    entries = spark.createDataFrame([("https://doi.org/a", None, [("f", 1, "h")]), ("q", "https://doi.org/c", [("f", 1, "other")])], "source_url string, effective_url string, files array<struct<path:string,size:bigint,sha256:string>>")
    complete = images.complete_entries(entries, spark.createDataFrame([("f", 1, "h")], "path string, size bigint, sha256 string"))
    broken = images.broken_entries(spark.createDataFrame([("# c",), ("",), ("2: https://doi.org/b",)], "value string"))
    found = {r.tm_id: r.outcome for r in images.classified_links(links, complete, broken).collect()}
    assert found == {"1": "already_present", "2": "broken", "3": "queued", "4": "todo"}
    fetched = spark.createDataFrame([("3", "https://doi.org/c", "failed"), ("9", "u", "downloaded")], "tm_id string, url string, result string")
    run = images.image_run(links, entries, spark.createDataFrame([("f", 1, "h")], "path string, size bigint, sha256 string"), broken, fetched)
    assert {r.tm_id: r.outcome for r in run.collect()} == {"1": "already_present", "2": "broken", "3": "failed", "4": "todo"}
    records = spark.createDataFrame([("1", '<a xmlns="n"><graphic url="u?a=1&amp;b"/><graphic/></a>'), ("2", "<a"), ("3", None)], "tm_id string, xml string")
    assert [tuple(r) for r in images.graphic_links(records).collect()] == [("1", "u?a=1&b")]
    chain = spark.createDataFrame([(f"p{i}", f"p{i + 1}") for i in range(25)], "url string, target string")
    assert [(r.effective_url, r.status) for r in images.resolved_links(spark.createDataFrame([("p0",)], "url string"), chain).collect()] == [("p25", "ok")]
    redirects = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("e", "")], "url string, target string")
    ends = {r.url: (r.effective_url, r.status) for r in images.resolved_links(spark.createDataFrame([("a",), ("x",), ("e",), ("k",)], "url string"), redirects).collect()}
    assert ends["a"] == ("c", "ok") and ends["x"][1] == "cycle" and ends["e"][1] == "empty" and ends["k"] == ("k", "ok")
    kind = "source_url string, effective_url string, scraper string, scraped_at string, source_ids array<string>, files array<struct<path:string,size:bigint>>"
    merged = images.merged_manifests(spark.createDataFrame([("u", "e", "s", "1", ["2"], [("f", 1), ("g", 1)])], kind), spark.createDataFrame([("u", "n", "t", "2", ["1", "2"], [("f", 9)])], kind)).collect()
    assert [(r.effective_url, r.scraper, r.scraped_at) for r in merged] == [("n", "t", "2")]
    assert [(r.source_ids, [tuple(f) for f in r["files"]]) for r in merged] == [(["1", "2"], [("f", 9), ("g", 1)])]
    assert images.apportioned([10000, 1, 0, 1, 1], 10) == [7, 1, 0, 1, 1] and images.apportioned([0, 0], 5) == [0, 0]


def test_manifests_and_pages():
    v3 = {"items": [{"items": [{"items": [{"motivation": "painting", "body": {"type": "Choice", "items": [{"service": [{"id": "https://s/1/"}]}]}}, {"motivation": "other", "body": {"id": "no"}}]}]}]}
    assert images.manifest_images(v3) == ["https://s/1/full/max/0/default.jpg"]
    v2 = {"sequences": [{"canvases": [{"images": [{"resource": {"@id": "u"}}, {"resource": {"@id": "u"}}]}]}]}
    assert images.manifest_images(v2) == ["u"]
    assert images.labelled_links('<p><a href="a.html">Grande <b>image</b></a><a href=b>x</a>', "http://h/d/", "grande image") == ["http://h/d/a.html"]
    assert images.embedded_json("<script>var json = {\"a\": 1}; let configuration = [2]</script>") == [{"a": 1}, [2]]
    assert images.content_urls('{"contentUrl": "x"}') == ["x"] and images.record_images('{"image": [{"urlImage": "y"}]}') == ["y"]


def test_corpus_tree(spark, tmp_path):
    def put(path, body):
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(body, encoding="utf-8")

    meta = lambda tm: f'<TEI><idno type="TM"> {tm} </idno></TEI>'
    for tm in (1, 53, 272):
        put(f"HGV_meta_EpiDoc/HGV1/{tm}.xml", meta(tm))
    for tm, inner in ((1, "Text 1."), (53, "Text 53."), (272, "<note>n</note><ab/>")):
        put(f"DDbDP/0/{tm}.xml", f'﻿<TEI><div type="edition" xml:lang="grc">{inner}</div></TEI>')
    for n in (1, 2):
        put(f"Translations/0/53-{n}.xml", '<TEI><div type="translation" xml:lang="en"><p>Words</p></div></TEI>')
    with pytest.raises(FileNotFoundError, match="DCLP"):
        corpus.require_directories(spark, str(tmp_path))
    put("DCLP/5/5000.xml", '<TEI><idno type="TM">5000</idno><div type="edition">own</div></TEI>')
    found = corpus.in_order(corpus.records(spark, str(tmp_path)))
    rows = [(r.tm_id, r.transcription_path, list(r.translation_paths)) for r in found.collect()]
    assert rows == [("1", "DDbDP/0/1.xml", []), ("272", None, []), ("53", "DDbDP/0/53.xml", ["Translations/0/53-1.xml", "Translations/0/53-2.xml"]), ("5000", "DCLP/5/5000.xml", [])]
    files = corpus.xml_files(spark, str(tmp_path), "", recursive=True)
    texts = sorted((r.tm_id, r.type, r.text) for r in corpus.document_table(found, files).collect())
    assert texts == [(1, "transcription", "Text 1."), (53, "transcription", "Text 53."), (53, "translation", "Words"), (53, "translation", "Words"), (5000, "transcription", "own")]


def test_dumps(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    df = spark.createDataFrame([(2, 'a "quoted"\nline'), (1, None)], schema)
    dumps.dump_csv(df, str(tmp_path / "t"), ["id", "name"], ["id"])
    assert sorted(map(tuple, dumps.read_csv(spark, str(tmp_path / "t"), schema).collect())) == [(1, None), (2, 'a "quoted"\nline')]
    with pytest.raises(ValueError):
        dumps.read_csv(spark, str(tmp_path / "t"), T.StructType([T.StructField("x", T.IntegerType()), T.StructField("name", T.StringType())]))
    names = dumps.GAZETTEER.fieldNames()
    (tmp_path / "geo.csv").write_text("﻿" + ",".join(names[:-1]) + "," + names[-1] + ";\n" + "7,Egypt" + "," * (len(names) - 2) + ";\n", encoding="utf-8")
    row = dumps.read_gazetteer(spark, str(tmp_path / "geo.csv")).first()
    assert (row.id, row.country, row.region, row.coordinates) == (7, "Egypt", None, None)
    stored = stored_rows(spark, [(1, "m", 0, "x"), (1, "other", 0, "y")])
    assert dumps.dump_embeddings(stored, str(tmp_path / "e"), "m") == 1
    assert dumps.import_embeddings(spark, str(tmp_path / "e"), stored, "m").count() == 2
    with pytest.raises(ValueError):
        dumps.import_embeddings(spark, str(tmp_path / "e"), stored, "other")
    assert dumps.safe_name("a/b c.") == "a-b-c."


def test_stream_refresh(spark, tmp_path):
    from ostraka.streaming.refresh import refresh_stream

    source, held = str(tmp_path / "docs"), {}
    schema = "transcription_id bigint, source_path string, tm_id bigint, text string, language string"
    spark.createDataFrame([(1, "p", 1, "one two", "en")], schema).write.parquet(source)
    held[0] = stored_rows(spark, [(1, "m", 1, "old"), (8, "m", 0, "kept")])
    stream = spark.readStream.schema(schema).parquet(source)
    query = refresh_stream(stream, lambda s: held[0], lambda df, n: held.update({0: s_copy(spark, df)}), "m", embeddings.hash_embedder(4), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert query.exception() is None
    assert sorted((r.xml_id, r.chunk_index, r.document_text) for r in held[0].collect()) == [(1, 0, "one two"), (8, 0, "kept")]


def s_copy(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def test_queries_that_need_no_sql_run(spark, data):
    import __spark_entry__ as entry
    from ostraka.plans import catalogue

    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name in ("path_inventory", "sentence_chunks", "snippet_hashes", "alias_matches"):
        assert catalogue.queries()[name](spark, data).count() > 0
    assert os.path.isdir(data)


def test_queries_match_their_sql(spark, data):
    duckdb = pytest.importorskip("duckdb")
    from ostraka.plans import catalogue

    connection = duckdb.connect()
    for name in os.listdir(data):
        if name.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{data}/{name}')")
    shown = lambda rows: sorted(tuple("" if v is None else f"{v:.5f}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    for name, sql in catalogue.oracle_sql().items():
        mine = catalogue.queries()[name](spark, data)
        theirs = connection.execute(sql)
        columns = [d[0] for d in theirs.description]
        assert sorted(columns) == sorted(mine.columns), name
        assert shown(map(tuple, mine.select(*columns).collect())) == shown(theirs.fetchall()), name
