import json

import pytest
from pyspark.sql import functions as F

from ostraka.operators import pages, reports
from ostraka.sources import manifests

METS = """<mets xmlns="m" xmlns:xlink="x"><fileSec><fileGrp USE="IVIEW2"><file ID="z"><FLocat xlink:href="z.jpg"/></file></fileGrp><fileGrp USE="MASTER">
<file ID="a" MIMETYPE="image/tiff"><FLocat xlink:href="a.tif"/></file><file ID="b"><FLocat xlink:href="b.jpg"/></file><file ID="c" MIMETYPE="text/xml"><FLocat xlink:href="c.xml"/></file></fileGrp></fileSec>
<structMap TYPE="PHYSICAL"><div><fptr FILEID="b"/><fptr FILEID="q"/></div></structMap></mets>"""


@pytest.mark.parametrize(
    ("site", "page", "base", "found"),
    [
        ("Aphrodito", '<a href="x.jpg">Grande image</a><a href="y.jpg">petite</a>', "http://h/p/1.html", ["http://h/p/x.jpg"]),
        ("CairoMuseum", '<a href="1.jpg">300 DPI image (b/w)</a><a href="2.jpg">72 dpi</a><a href="http://h/3.jpg">300 dpi image (colour)</a><a href="4.html">300 dpi image (colour)</a>', "http://ipap.csad.ox.ac.uk/", ["http://ipap.csad.ox.ac.uk/1.jpg"]),
        ("Egnet", "", "http://www.ifao.egnet.net/bases/publications/fifao81/?id=a-1", ["http://www.ifao.egnet.net/bases/publications/fifao81/docs/vignettes/a-1.jpg"]),
        ("Egnet", '<img src="x.jpg"><img src="docs/vignettes/b.JPG"><img src="docs/vignettes/c.jpg">', "http://www.ifao.egnet.net/bases/publications/fifao67/?os=3", ["http://www.ifao.egnet.net/bases/publications/fifao67/docs/vignettes/b.JPG"]),
        ("Oxford", "", "https://portal.sds.ox.ac.uk/articles/online_resource/x/1?file=22", ["https://ndownloader.figshare.com/files/22"]),
        ("MetMuseum", r'<script>x = "{\"originalImageUrl\":\"https://images.metmuseum.org/a.jpg\"}"; y = {"originalImageUrl": "https://images.metmuseum.org/b.jpg"}</script>', "", ["https://images.metmuseum.org/a.jpg", "https://images.metmuseum.org/b.jpg"]),
        ("PSIOnline", '<a href="/documents/download?filen=1.jpg">a</a><a href="/documents/download">b</a><a href="/documents/download?filen=1.jpg">c</a>', "http://psi-online.it/documents/x", ["http://psi-online.it/documents/download?filen=1.jpg"]),
        ("Warsaw", "", "http://www.papyrology.uw.edu.pl/papyri/p1.htm", ["https://www.papyrology.uw.edu.pl/papyri/p1.jpg"]),
        ("PapyrusPortal", METS, "", ["b.jpg", "a.tif"]),
        ("PapyrusPortal", '<script>var json = {"metsURL": "/m.xml"};</script>', "http://h/x", ["http://h/m.xml"]),
        ("Oxford", json.dumps({"files": [{"mimetype": "image/png", "download_url": "u"}, {"mimetype": "text/plain", "download_url": "v"}]}), "", ["u"]),
        ("UniKoeln", '<a href="0.jpg">x</a>Abbildung: <a href="1.jpg">x</a><a href="t.html">x</a>', "http://h/", ["http://h/1.jpg"]),
        ("UBHeidelberg", '<a href="/iiif/manifest.json">m</a><a href="/iiif3/manifest.json">m</a>', "http://h/", ["http://h/iiif3/manifest.json"]),
        ("BerlPap", '<table><tr><td><b>Digitalisate:</b></td><td><a href="/Original/1.jpg">x</a><a href="/other">y</a></td></tr></table><a href="/Original/2.jpg">z</a>', "https://berlpap.smb.museum/", ["https://berlpap.smb.museum/Original/1.jpg"]),
        ("BerlPap", '<table><tr><td><b>Publizierte Abbildungen</b><a href="mailto:x">m</a><a href="http://o/1">x</a><a href="http://o/2">y</a></td></tr></table>', "https://berlpap.smb.museum/", ["http://o/1"]),
        ("UCBerkeley", '{"contentUrl": ["a", "b"]}', "", ["a", "b"]),
    ],
)
def test_rules(site, page, base, found):
    assert pages.RULES[site](page, base) == found


def test_walks_over_several_pages():
    site = {
        "https://www.britishmuseum.org/collection/object/Y_1": '<a href="/collection/image/7">x</a><a href="/collection/image/8">y</a>', "https://www.britishmuseum.org/collection/image/7": '<a href="http://d/7.jpg">Download this image</a>',
        "https://www.britishmuseum.org/collection/image/8": '<a href="http://d/8.jpg">Download this image</a><a href="/collection/image/7">back</a>', "http://h/x": '<script>var json = {"metsURL": "/mets.xml"};</script>', "http://h/mets.xml": METS,
        "http://u/d": '<a href="/iiif3/manifest.json">m</a>', "http://u/iiif3/manifest.json": json.dumps({"items": [{"items": [{"items": [{"body": {"id": "i"}}]}]}]}),
    }
    assert pages.walk("BritishMuseum", "https://www.britishmuseum.org/collection/object/Y_1", site.__getitem__) == ["http://d/7.jpg", "http://d/8.jpg"]
    assert pages.walk("PapyrusPortal", "http://h/x", site.__getitem__) == ["b.jpg", "a.tif"]
    assert pages.walk("UBHeidelberg", "http://u/d", site.__getitem__) == ["i"]
    assert pages.walk("Oxford", "http://o/1?file=3", lambda _: "") == ["https://ndownloader.figshare.com/files/3"]


def test_rules_on_a_table(spark):
    df = spark.createDataFrame([("Louvre", "not json", ""), ("Nowhere", "x", ""), (None, None, None), ("Nakala", None, "u")], "h string, p string, u string")
    assert [r.x for r in df.select(pages.image_addresses(F.col("h"), F.col("p"), F.col("u")).alias("x")).collect()] == [[], None, None, ["u"]]


def test_manifests(spark, tmp_path):
    (tmp_path / "1").mkdir()
    (tmp_path / "2").mkdir()
    (tmp_path / "1/manifest.json").write_text(json.dumps({"version": 1, "entries": [{"source_url": "u", "source_ids": ["1"], "files": [{"path": "a.txt", "size": 3}]}]}))
    (tmp_path / "2/manifest.json").write_text(json.dumps({"version": 9, "entries": [{"source_url": "v"}]}))
    found = manifests.read_manifests(spark, str(tmp_path / "*/manifest.json"))
    assert [r.source_url for r in found.collect()] == ["u"]
    manifests.write_manifests(found.withColumn("directory", F.lit("1")), str(tmp_path / "out"))
    again = manifests.read_manifests(spark, str(tmp_path / "out/directory=1/*.json")).drop("directory").collect()
    assert again == found.drop("directory").collect()
    (tmp_path / "files").mkdir()
    (tmp_path / "files/a.txt").write_text("abc")
    before = manifests.file_records(spark, str(tmp_path / "files"))
    assert [(r.path, r.size) for r in before.collect()] == [("a.txt", 3)]
    assert manifests.changed_files(before, before).count() == 0
    manifests.write_lines(before, F.col("path"), str(tmp_path / "lines"))
    assert [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()] == ["a.txt"]


def test_reports(spark, data):
    read = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    places = reports.place_families(read("orig_places"), read("export_geo"))
    text = reports.to_markdown(places)
    assert "## Coverage" in text and "| scope |" in text
    parsed = json.loads(reports.to_json(places))
    assert sum(r["places"] for r in parsed["Granularity"]) == read("orig_places").count()
    rows = [(1, -10, None, None, 5, None, None, "low", None, False), (1, 150, 3, 4, 150, 3, 4, None, None, True)]
    dated = spark.createDataFrame(rows, "tm_id int, not_before_year int, not_before_month int, not_before_day int, not_after_year int, not_after_month int, not_after_day int, certainty string, precision string, alternative boolean")
    families = reports.date_families(dated, spark.createDataFrame([(1,), (2,)], "tm_id int"))
    assert {r["items"]: r.documents for r in families["Dates of a record"].collect()} == {0: 1, 2: 1}
    assert families["101 to 200"].first().any_overlaps == 1
    inventory = reports.inventory_families(read("transcriptions"), "transcription_id", "xml_content")
    assert inventory["Elements"].first().documents > 50
    assert reports.markdown_code("a|b`c" + "x" * 100).startswith("``a\\|b`c")


def test_compatibility(spark):
    kind = "tm_id string, source_rank int, transcription_path string, translation_paths array<string>"
    good = spark.createDataFrame([("1", 0, "t", ["a", "b"]), ("2", 1, None, [])], kind)
    assert reports.compatibility(good)["translations"] == 2
    with pytest.raises(ValueError, match="dclp_records"):
        reports.compatibility(good.filter("source_rank = 0"))
