import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ostraka.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary")


@given(st.text(st.sampled_from("ab é'sτοῦ12 .,\n\t 　\x1c"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_counts_are_those_of_the_whole_text(text):
    counter = tokens.counter(tokens.VOCABULARY)
    assert counter.count(text) == counter.exact(text)


def test_a_full_memo_starts_afresh(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    counter = tokens.TokenCounter()
    for text in ("one two three four", "five six seven eight", "one two three four"):
        assert counter.count(text) == counter.exact(text)


ROWS = [(1, "alpha beta", "a"), (2, "alpha beta", "b"), (3, None, "a"), (4, "", None), (4, "gamma", "a")]


def snapshot(spark, rows, ledger):
    df = spark.createDataFrame(rows, "id int, text string, source string")
    return tokens.measured(df, "id", "text", {"source": F.col("source")}, ledger)


@pytest.fixture
def ledger(spark, tmp_path):
    return tokens.Ledger(spark, str(tmp_path / "ledger"))


def encoded(spark, ledger):
    """How many contents were encoded so far: each leaves one stored row."""
    return spark.read.parquet(ledger.path).count()


def test_counts_and_cubes(spark, ledger):
    s = snapshot(spark, ROWS, ledger)
    exact = tokens.counter(tokens.VOCABULARY).exact
    assert sorted((r.key, r.source or "", r.tokens) for r in s.collect()) == sorted([(1, "a", exact("alpha beta")), (2, "b", exact("alpha beta")), (3, "a", 0), (4, "", 0), (4, "a", exact("gamma"))])
    cube = {(r.level, r.source): (r.documents, r.tokens) for r in tokens.token_cube(tokens.finest_cells(s, ["source"]), ["source"]).collect()}
    assert cube[1, None] == (5, 2 * exact("alpha beta") + exact("gamma")) and cube[0, None] == (1, 0)
    assert encoded(spark, ledger) == 3
    assert snapshot(spark, [], ledger).count() == 0
    with pytest.raises(ValueError):
        tokens.measured(s, "key", "source", {"tokens": F.col("tokens")}, ledger)


def test_only_unseen_contents_are_encoded(spark, ledger):
    snapshot(spark, [*ROWS, *((100 + i, "copied", "a") for i in range(50))], ledger)
    assert encoded(spark, ledger) == 4
    later = tokens.Ledger(spark, ledger.path)
    again = snapshot(spark, [*ROWS, (9, "new words", "a"), (10, "new words", "b")], later)
    exact = tokens.counter(tokens.VOCABULARY).exact
    assert {r.key: r.tokens for r in again.collect() if r.key != 4} == {1: exact("alpha beta"), 2: exact("alpha beta"), 3: 0, 9: exact("new words"), 10: exact("new words")}
    assert encoded(spark, ledger) == 5
    snapshot(spark, ROWS, later)
    assert encoded(spark, ledger) == 5
    # what stands in the table is taken from it, under the tokenizer that it was made for only
    spark.createDataFrame([("kept", 1000)], "text string, tokens bigint").select(tokens.content_hash(F.col("text")).alias("content_hash"), "tokens", F.lit(ledger.tokenizer).alias("tokenizer_hash"), F.lit("0").alias("prefix")).write.mode("append").partitionBy("tokenizer_hash", "prefix").parquet(ledger.path)
    assert [r.tokens for r in snapshot(spark, [(1, "kept", "a")], later).collect()] == [1000]
    later.tokenizer = "another"
    assert [r.tokens for r in snapshot(spark, [(1, "kept", "a")], later).collect()] == [exact("kept")]


def test_a_setting_names_a_ledger_that_outlives_the_job(spark, tmp_path):
    spark.conf.set(tokens.LEDGER_SETTING, str(tmp_path / "kept"))
    try:
        snapshot(spark, ROWS, tokens.Ledger(spark))
        assert tokens.Ledger(spark).exists() and encoded(spark, tokens.Ledger(spark)) == 3
    finally:
        spark.conf.unset(tokens.LEDGER_SETTING)
    assert not tokens.Ledger(spark).exists()


def test_deltas_lead_from_one_cube_to_the_next(spark, ledger):
    after = [(1, "alpha beta changed", "a"), (2, "alpha beta", "c"), (4, "gamma", "a"), (7, "added", "a")]
    a, b = snapshot(spark, ROWS, ledger), snapshot(spark, after, ledger)
    changes = tokens.signed_changes(a, b, ["source"])
    assert sorted((r.key, r.change, r.documents) for r in changes.collect()) == [(1, "changed", -1), (1, "changed", 1), (2, "changed", -1), (2, "changed", 1), (3, "removed", -1), (4, "removed", -1), (7, "added", 1)]
    delta = tokens.cube_delta(changes, ["source"])
    got = sorted((r.source or "", r.documents, r.tokens) for r in tokens.apply_delta(tokens.finest_cells(a, ["source"]), delta, ["source"]).collect())
    assert got == sorted((r.source or "", r.documents, r.tokens) for r in tokens.finest_cells(b, ["source"]).collect())
    assert tokens.signed_changes(a, a, ["source"]).count() == 0


def test_rows_and_totals_come_out_together(spark, data):
    from ostraka.llm.catalogue import p2_tokens

    rows = p2_tokens(spark, data).collect()
    single = [r for r in rows if r.level is None]
    assert len(single) == spark.read.parquet(f"{data}/transcriptions.parquet").count()
    whole = [r for r in rows if r.level == 7]
    assert [(r.documents, r.tokens) for r in whole] == [(len(single), sum(r.tokens for r in single))]
    for r in rows:
        if r.level == 0:
            mine = [s for s in single if (s.source, s.language, s.type) == (r.source, r.language, r.type)]
            assert (r.documents, r.tokens) == (len(mine), sum(s.tokens for s in mine))
