import json
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ostraka.__main__ import parser
from ostraka.operators import biblio, providers
from ostraka.operators.embeddings import hash_embedder
from ostraka.sources.warehouse import Warehouse, term_vector


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")

    def put(path, body):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(body, encoding="utf-8")

    for tm in (1, 2, 30):
        put(f"HGV_meta_EpiDoc/HGV1/{tm}.xml", f'<TEI><teiHeader><fileDesc><publicationStmt><idno type="TM">{tm}</idno></publicationStmt></fileDesc><profileDesc><textClass><keywords scheme="hgv"><term>k{tm}</term></keywords></textClass></profileDesc></teiHeader></TEI>')
        put(f"DDbDP/0/{tm}.xml", f'<TEI><div type="edition" xml:lang="grc"><ab>λόγος {"δύο " * tm}</ab></div></TEI>')
        put(f"Translations/0/{tm}-1.xml", f'<TEI><div type="translation" xml:lang="en"><p>word {tm}</p></div></TEI>')
    put("DCLP/0/9.xml", '<TEI><teiHeader><fileDesc><publicationStmt><idno type="TM">9</idno></publicationStmt></fileDesc></teiHeader></TEI>')
    return str(root)


@pytest.fixture(scope="module")
def warehouse(spark, tree, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    w.ingest_metadata(tree)
    w.ingest_documents(tree)
    return w


def test_metadata_tables(warehouse, tmp_path):
    assert [(r.keyword_id, r.tm_id, r.keyword) for r in warehouse.read("keywords").orderBy("keyword_id").collect()] == [(1, 1, "k1"), (2, 2, "k2"), (3, 30, "k30")]
    assert warehouse.read("papyri").count() == 4
    warehouse.dump_metadata(str(tmp_path / "dump"))
    assert warehouse.spark.read.csv(str(tmp_path / "dump/keywords"), header=True).columns == ["keyword_id", "tm_id", "scheme", "keyword_type", "keyword", "uncertain"]


def test_documents_round_trip_and_search(warehouse, tmp_path):
    before = sorted(map(tuple, warehouse.read("transcriptions").collect()))
    assert len(before) == 6 and [r[0] for r in before] == list(range(1, 7))
    warehouse.lemmatize()
    assert warehouse.read("transcriptions").filter("lemma_text is not null").count() == 3
    warehouse.dump_documents(str(tmp_path / "d"))
    after = sorted(map(tuple, warehouse.read("transcriptions").collect()))
    warehouse.import_documents(str(tmp_path / "d"))
    assert sorted(map(tuple, warehouse.read("transcriptions").select("transcription_id", "source_path", "tm_id", "xml_content", "type", "language", "text", "lemma_text").collect())) == after
    assert [r.tm_id for r in warehouse.search("δύο", 1).collect()] == [30]


def test_vectors(warehouse, tmp_path):
    assert warehouse.embed("m", hash_embedder(8)) == 6
    assert warehouse.embed("m", hash_embedder(8), stale_only=True) == 0
    assert warehouse.embed("other", hash_embedder(4), sample=2) == 4
    report = warehouse.evaluate("m").to_markdown()
    assert "| m | all | 3 |" in report and "| m | 8 | 3 | 3 | 3 | 3 | 3 | 0 | 0 | " in report
    assert warehouse.evaluate("m", sample=1).to_markdown().startswith("A sample of 1 paired records, seed 0.")
    assert len(warehouse.vector_of("m", "DDbDP/0/1.xml")) == 8 and warehouse.vector_of("m", "none") is None
    assert warehouse.dump_model(str(tmp_path / "v"), "m") == 3
    assert warehouse.import_model(str(tmp_path / "v"), "m") == 3
    other = warehouse.read("transcription_embeddings", part="other").inputFiles()
    assert warehouse.parts("transcription_embeddings") == ["m", "other"]
    assert warehouse.delete_model("m") == 6 and warehouse.read("transcription_embeddings").inputFiles() == other
    assert warehouse.import_model(str(tmp_path / "v"), "m") == 3
    assert warehouse.embed("m", hash_embedder(8)) == 6
    assert warehouse.embed("short", lambda texts: [None if "30" in t else [1.0] for t in texts]) == 5
    assert [r.xml_id for r in warehouse.skipped["translation"].collect()] == [6] and warehouse.skipped["transcription"].count() == 0
    assert warehouse.delete_model("short") == 5 and warehouse.delete_model("other") == 4 and warehouse.delete_model("none") == 0
    with pytest.raises(ValueError):
        warehouse.evaluate("other")


def test_tables_change_together_or_not_at_all(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    w.write_together({"a": one, "b": one})
    reader = w.read("a")
    bad = one.select(F.raise_error(F.lit("broken")).cast("int").alias("id"))
    with pytest.raises(Exception, match="broken"):
        w.write_together({"a": one.withColumn("id", F.lit(2)), "b": bad})
    assert [r.id for r in w.read("a").collect()] == [1] and w.next_id("a", "id") == 2 and w.next_id("none", "id") == 1
    w.write("a", one.withColumn("id", F.lit(5)))
    assert [r.id for r in reader.collect()] == [1]  # the version just replaced stays readable
    assert [r.id for r in w.read("a").collect()] == [5] and [r.id for r in w.read("b").collect()] == [1]
    wider = w.read("a", T.StructType([T.StructField("id", T.IntegerType()), T.StructField("later", T.StringType())]))
    assert [tuple(r) for r in wider.collect()] == [(5, None)]
    with pytest.raises(FileNotFoundError):
        w.read("a", part="none")


def test_documents_are_numbered_on(warehouse, spark):
    before = warehouse.read("transcriptions")
    n, most = before.count(), warehouse.next_id("transcriptions", "transcription_id")
    warehouse.append_documents(spark.createDataFrame([("x/1", 7, "transcription", "new"), ("x/0", 7, "transcription", "newer")], "source_path string, tm_id bigint, type string, text string"), ["source_path"])
    new = warehouse.read("transcriptions").filter(F.col("transcription_id") >= most).orderBy("transcription_id").collect()
    assert [(r.transcription_id, r.text, r.xml_content) for r in new] == [(most, "newer", None), (most + 1, "new", None)]
    assert warehouse.read("transcriptions").count() == n + 2


def test_term_vectors(spark):
    rows = spark.createDataFrame([("b a b",), ("",), (None,)], "t string").select(term_vector(F.col("t")).alias("v")).collect()
    assert [r.v for r in rows] == ["'a':2 'b':1,3", "", None]


def test_providers():
    assert len(providers.provider_for("hash:4", "m").embed(["a"])[0]) == 4
    with pytest.raises(ValueError):
        providers.provider_for("ftp://example.org", "m")
    short = providers.CheckedProvider(lambda texts: [[1.0]] * len(texts), context_tokens=1)
    assert short.embed(["a", "a long text"]) == [[1.0], None]
    for bad in ([float("inf")], []):
        with pytest.raises(ValueError):
            providers.CheckedProvider(lambda texts, v=bad: [v]).embed(["a"])
    assert providers.base_address("https://h/x/?q=1") == "https://h/x/v1" and providers.base_address("http://h/v1/") == "http://h/v1"
    assert providers.error_summary({"error": {"message": "no", "code": 4, "param": None}}) == "no; code: 4" and providers.error_summary("x") == "x"


def test_services_by_their_answers(monkeypatch):
    asked = []

    def answer(method, address, body, headers):
        asked.append((method, address, headers.get("Authorization")))
        if address.endswith("/version"):
            return {"version": "1"} if "own" in address else {}
        if address.endswith("/tokenize"):
            return {"count": len(body["prompt"]), "max_model_len": 99}
        if "/models/" in address:
            return {"max_context_length": 77}
        return {"data": [{"embedding": [1, 2.5]}], "usage": {"prompt_tokens": 3, "total_tokens": 4}}

    monkeypatch.setattr(providers.RemoteProvider, "transport", staticmethod(answer))
    facts = {}
    for address in ("https://api.mistral.ai", "https://api.openai.com/v1/", "https://API.voyageai.com", "http://own:8000/v1"):
        p = providers.provider_for(address, "a/b", "k")
        facts[type(p).__name__] = (p.embed(["x"]), p.token_count("abcd"), p.context_length(), p.embedding_length())
    assert facts == {"MistralProvider": ([[1.0, 2.5]], 3, 77, 2), "OpenAIProvider": ([[1.0, 2.5]], 3, 8192, 2), "VoyageProvider": ([[1.0, 2.5]], 4, 32000, 2), "LocalServerProvider": ([[1.0, 2.5]], 4, 99, 2)}
    assert ("GET", "https://api.mistral.ai/v1/models/a%2Fb", "Bearer k") in asked and ("POST", "http://own:8000/v1/embeddings", "Bearer k") in asked
    with pytest.raises(ValueError, match="no provider"):
        providers.provider_for("https://example.org", "m")
    for bad in ({}, {"data": []}, {"data": [{"embedding": [1]}], "usage": {"prompt_tokens": True}}, {"data": [{"embedding": []}], "usage": {"prompt_tokens": 1}}, []):
        monkeypatch.setattr(providers.RemoteProvider, "transport", staticmethod(lambda *_, b=bad: b))
        with pytest.raises(ValueError):
            providers.OpenAIProvider("https://api.openai.com/v1", "m", "k").embed(["x"])


def test_bibliography(spark):
    record = '<bibl xml:id="b7" type="book"><idno type="pi">7</idno><title level="m" type="main">T</title><author><forename>A</forename><surname>B</surname></author><date>ca. 1923</date><biblScope unit="pp">3</biblScope><relatedItem type="appearsIn"><bibl><ptr target="https://papyri.info/biblio/9"/></bibl></relatedItem></bibl>'
    df = spark.createDataFrame([("x/7.xml", record), ("x/8.xml", record), ("x/bad.xml", "<bibl"), ("n", None)], "source_path string, xml string")
    facts = biblio.biblio_facts(df)
    counts = {(r.kind, r.value): r.records for r in biblio.fact_counts(facts).collect()}
    assert counts["identity", "consistent"] == 1 and counts["identity", "different"] == 1 and counts["date", "1923"] == 2 and counts["contributor", "author:forename + surname"] == 2 and counts["error", None] == 1
    assert [(r.source, r.relation, r.target, r.times) for r in biblio.relation_edges(facts).collect()] == [("7", "appearsIn", "9", 2)]
    assert [(r.biblio_id, r.records) for r in biblio.duplicate_ids(facts).collect()] == [("7", 2)]
    assert [(r.biblio_id, r.place) for r in biblio.metadata_pointers(df.filter("source_path = 'x/7.xml'")).collect()] == [("9", "bibl")]


def test_image_runs(spark, tmp_path):
    from ostraka.sources import image_run

    def put(path, body):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(body, encoding="utf-8")

    doi = "https://doi.org/10.1/"
    for tm, urls in ((1, [doi + "a", doi + "b"]), (2, [doi + "c", doi + "c", "https://example.org/x"]), (3, [doi + "down", doi + "bad"])):
        marks = "".join(f'<graphic url="{u}"/>' for u in urls)
        put(f"corpus/HGV_meta_EpiDoc/HGV1/{tm}.xml", f'<TEI><idno type="TM">{tm}</idno><facsimile>{marks}<graphic/></facsimile></TEI>')
    for name in ("DDbDP", "Translations", "DCLP"):
        put(f"corpus/{name}/0/0.txt", "")
    put("corpus/DDbDP/0/7.xml", "<TEI/>")
    put("corpus/Translations/0/7-1.xml", "<TEI/>")
    put("corpus/DCLP/0/8.xml", '<TEI><idno type="TM">8</idno></TEI>')
    put("images/1/a.txt", "abc")
    entry = {"source_url": doi + "a", "files": [{"path": "a.txt", "size": 3, "sha256": "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"}]}
    put("images/1/manifest.json", json.dumps({"version": 1, "entries": [entry]}))
    broken = spark.createDataFrame([(f"1: {doi}b",)], "value string")
    source, target = str(tmp_path / "corpus"), str(tmp_path / "images")
    first = image_run.run_images(spark, source, target, broken)
    assert sorted((r.tm_id, r.url.rpartition("/")[2], r.outcome) for r in first.links.collect()) == [("1", "a", "already_present"), ("1", "b", "broken"), ("2", "c", "queued"), ("2", "x", "todo"), ("3", "bad", "queued"), ("3", "down", "queued")]

    def fetch(handler, tm_id, url):
        if url.endswith("down"):
            raise image_run.Unavailable(handler)
        if url.endswith("bad"):
            raise OSError("no such page")
        folder = pathlib.Path(target) / tm_id
        folder.mkdir(exist_ok=True)
        (folder / "c.txt").write_text("xy")
        return ["c.txt"]

    done = image_run.run_images(spark, source, target, broken, fetch)
    got = {(r.tm_id, r.url.rpartition("/")[2]): r.outcome for r in done.links.collect()}
    assert got["2", "c"] == "downloaded" and got["3", "down"] == "unavailable" and got["3", "bad"] in ("failed", "unavailable")
    made = done.entries.collect()
    assert [(r.directory, r.source_url, r.scraper, [(f.path, f["size"]) for f in r.files]) for r in made] == [("2", doi + "c", "DOI", [("c.txt", 2)])]
    done.write_lists(str(tmp_path / "lists"))
    assert spark.read.text(str(tmp_path / "lists/todo")).first().value == "2: https://example.org/x"
    assert {r.handler: r.downloaded for r in done.counts().collect()} == {"DOI": 1}


def test_commands():
    a = parser().parse_args(["--warehouse", "w", "embeddings", "update", "hash:4", "m", "--sample", "3"])
    assert (a.group, a.command, a.model, a.sample, a.chunk_size, a.seed) == ("embeddings", "update", "m", 3, 500, 0)
    with pytest.raises(SystemExit):
        parser().parse_args(["--warehouse", "w", "metadata"])
