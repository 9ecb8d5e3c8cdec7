from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ostraka.llm import splitting as s


def total(cuts, penalties, limit, overlap):
    n = len(penalties) - 1
    pieces = 1 + -(-(n - limit) // (limit - overlap))
    ideal = (n + overlap * (pieces - 1)) / pieces
    out = 0.0
    for i, j in zip(cuts, cuts[1:]):
        size = j - i + (overlap if i else 0)
        if size > limit or i and i <= overlap:
            return np.inf
        out += s.BALANCE * ((size - ideal) / ideal) ** 2 + penalties[j]
    return out


@given(st.lists(st.sampled_from([0.0, 0.25, 1.0, 16.0]), min_size=6, max_size=11), st.integers(3, 5), st.integers(0, 2))
@settings(max_examples=120, deadline=None)
def test_cuts_are_the_best_of_all(costs, limit, overlap):
    penalties = np.array([0.0, *costs, 0.0])
    n = len(penalties) - 1
    if n <= limit:
        assert s.best_cuts(penalties, limit, overlap) == [0, n]
        return
    every = [[0, *c, n] for k in range(1, n) for c in combinations(range(1, n), k)]
    best = min(total(c, penalties, limit, overlap) for c in every)
    assert total(s.best_cuts(penalties, limit, overlap), penalties, limit, overlap) == pytest.approx(best)


@given(st.text(st.sampled_from("ab.\n  ​ \x1c,·"), max_size=200), st.integers(1, 6), st.integers(0, 3))
@settings(max_examples=200, deadline=None)
def test_pieces_cover_the_words_and_overlap(text, limit, overlap):
    overlap = min(overlap, limit - 1)
    words = s.WORD.findall(text)
    pieces = s.split_text(text, limit, overlap)
    assert s.over(text, limit) == (len(words) > limit)
    if len(words) <= limit:
        assert pieces == [(0, len(words), text)]
        return
    assert pieces[0][0] == 0 and pieces[-1][0] + pieces[-1][1] == len(words)
    for (a, n, piece), (b, _, _) in zip(pieces, pieces[1:] + [(len(words) - overlap, 0, "")]):
        assert n <= limit and s.WORD.findall(piece) == words[a : a + n] and b == a + n - overlap


@pytest.mark.parametrize(("text", "limit", "more"), [("a \x1c", 1, True), ("a\x1cb c", 2, False), ("a\x1cb c", 1, True), ("a\u200bb c", 1, True), ("a\u00a0b", 1, True), (None, 1, False), ("ab", 1, False)])
def test_words_are_those_of_unicode(text, limit, more):
    assert s.over(text, limit) is more


def test_cuts_stand_at_sentence_ends():
    text = " ".join("one two three four five six seven." for _ in range(10))
    assert [p.endswith(".") for _, _, p in s.split_text(text, 20, 0)] == [True] * len(s.split_text(text, 20, 0))


def test_tables(spark):
    rows = [(1, "a b c d e", "x"), (1, "a b c d e", "y"), (2, None, "x"), (3, "", "x"), (4, "a b", "x"), (None, "w " * 3000, "x")]
    df = spark.createDataFrame(rows, "id int, text string, piece string")
    got = s.split_oversized(df, "text", ["id"], limit=3, overlap=1)
    assert [(r.piece_index, r.first_word, r.words, r.piece) for r in got.filter("id = 1").collect()] == 2 * [(0, 0, 3, "a b c"), (1, 2, 3, "c d e")]
    assert got.filter("id is null").count() == 1500 - 1 + 1 and got.filter("id in (2, 3, 4)").count() == 0
    assert sorted(r.id or 0 for r in s.oversized(df, "text", 3).collect()) == [0, 1, 1]
    assert s.split_oversized(df.limit(0), "text", ["id"]).count() == 0
    with pytest.raises(ValueError):
        s.split_oversized(df, "text", ["piece"])
    for limit, overlap in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            s.split_oversized(df, "text", ["id"], limit, overlap)
