import itertools
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ostraka.llm import names as n

PERSON = ["Katharina Lerberren", "K. Lerberren", "Lerberren, Katharina", "Lerberren K.", "LERBERREN, Katharina", "Käthe Lerberren", "Kath. Lerberren", "Katharina A. Lerberren", "Prof. Katharina Lerberren", "Katharina Ler-Berren", "Katharina Lerbrrren", "Lerberren (ed. pr.)"]
# surnames beside which the short forms stand, so that the data show them; none of these forms is in any list
WITNESSES = [f"{g} {s}" for s in ("Bolnimvar", "Kusterwalm", "Zandorfil") for g in ("Katharina", "Käthe", "Theodora", "Dora", "James", "Jim")] + [f"{g} Restwin{c}ol" for g in ("Katharina", "Theodora", "James") for c in "abcdefgh"]
OTHERS = ["Theodora Dangelram", "T. Dangelram", "Thomas Dangelram", "Dangelram", "Dora Dangelram"]
HOUSE = ["Papyrus Institute Gomvosgir", "Inst. of Papyrology, Gomvosgir", "Gomvosgir Papyrus Institute", "PAPYRUS INSTITUTE GOMVOSGIR", "P.I. Gomvosgir", "Papyrus Institut Gomvsogir"]
ANCIENT = ["Demdylkornelus Tarsomiensis", "Demdylkornel. Tarsomiensis", "Demdylkornelos, of Tarsomia", "Demdylkornelos", "ΔΕΜΔΥΛΚΟΡΝΕΛΟΣ", "Δεμδυλκορνέλος Ταρσομιέυς", "Tarsomiensis Demdylkornelus", "Demdylkornelus poeta", "Demdylkornelus (?)", "Demdylkornelsu"]
NOBODY = ["?", "s.n.", "N.N.", "various", "Redaktion der Sammlung", "", None]


def entities(spark, modern, ancient=()):
    df = spark.createDataFrame([(x, False) for x in modern] + [(x, True) for x in ancient], "author string, ancient boolean")
    out = {}
    for r in n.link_names(df).collect():
        out.setdefault(r.entity, set()).add(r.author)
    return sorted(map(sorted, out.values()))


def test_variants_are_linked(spark):
    got = [e for e in entities(spark, PERSON + OTHERS + HOUSE + NOBODY + PERSON[:3] + WITNESSES, ANCIENT) if not set(e) & set(WITNESSES)]
    want = [set(PERSON), set(HOUSE), set(ANCIENT), {"Theodora Dangelram", "Dora Dangelram"}, {"Thomas Dangelram"}, {"T. Dangelram"}, {"Dangelram"}]
    assert got == sorted(map(sorted, want))
    assert entities(spark, NOBODY) == []


def test_pairs(spark):
    df = spark.createDataFrame([("B. Longername", "e"), ("A. Longername", "e"), ("x", "f")], "author string, entity string")
    assert [tuple(r) for r in n.name_pairs(df).collect()] == [("A. Longername", "B. Longername")]


def test_short_forms_are_told_by_the_data(spark):
    people = [(g, s) for s in ("aaaaa", "bbbbb", "ccccc") for g in ("james", "jim")] + [("james", s) for s in ("ddddd", "eeeee")] + [("tom", "aaaaa"), ("tom", "fffff"), ("peter", "fffff"), ("peter", "ggggg")]
    df = spark.createDataFrame([("person", s, g) for g, s in people], "kind string, core string, given string")
    assert [tuple(r) for r in n.short_forms(df).collect()] == [("person", "jim", "james")]
    known = spark.createDataFrame([("person", "peggy", "margaret")], "kind string, given string, whole string")
    authors = spark.createDataFrame([("Peggy Ombril", False), ("Margaret Ombril", False)], "author string, ancient boolean")
    assert n.link_names(authors, known).select("entity").distinct().count() == 1
    assert n.link_names(authors).select("entity").distinct().count() == 2


def told(spark, people):
    df = spark.createDataFrame([("person", s, g) for s, g in people], "kind string, core string, given string")
    return {r.given: r.whole for r in n.short_forms(df).collect()}


@pytest.mark.parametrize("others", [0, 4, 5, 30])
def test_surnames_of_any_number_of_forenames_are_evidence(spark, others):
    three = ("aaaaa", "bbbbb", "ccccc")
    people = {(s, g) for s in three for g in ["jim", *(f"{s}{i}" for i in range(others))]} | {(f"single{i}", f"forename{i % 40}") for i in range(2000)}
    assert told(spark, people | {(s, "jeremias") for s in (*three, "ddddd", "eeeee")}) == {"jim": "jeremias"}
    # a forename that is frequent stands beside any other by chance where there are many
    assert told(spark, people | {(s, "peter") for s in (*three, *(f"peter{i}" for i in range(30)))}) == ({"jim": "peter"} if others < 30 else {})


def test_what_is_beside_everything_is_no_evidence(spark):
    crowd = {(s, f"forename{i}") for s in ("aaaaa", "bbbbb") for i in range(40)} | {(f"single{j}", f"forename{i}") for i in range(40) for j in range(3)}
    assert told(spark, crowd | {("aaaaa", "zebulon"), ("bbbbb", "zebulon")}) == {}


def test_short_forms_by_brute_force(spark):
    rng = random.Random(7)
    people = set()
    for s in range(60):
        for _ in range(rng.choice((1, 2, 3, 9, 20))):
            g = f"g{int(rng.paretovariate(0.6)) % 300}"
            people |= {(f"s{s}", g)} | ({(f"s{s}", g + "short")} if rng.random() < 0.1 else set())
    beside, cores = {}, {}
    for s, g in people:
        beside.setdefault(s, set()).add(g)
        cores.setdefault(g, set()).add(s)
    want = {}
    looked_at = sum(1 < len(c) < max(map(len, cores.values())) for c in cores.values())
    for a in cores:
        k, more = len(cores[a]), sum(len(c) > len(cores[a]) for c in cores.values())
        for b in cores:
            shared = cores[a] & cores[b]
            if len(cores[b]) <= k or len(shared) < max(2, 0.75 * k):
                continue
            by_chance = sum(math.log(1 - (1 - len(cores[b]) / len(people)) ** (len(beside[s]) - 1)) for s in shared)
            expected = by_chance + math.log(math.comb(k, len(shared)) * more * looked_at)
            few = sum(len(beside[s]) <= n.SELECTIVE for s in shared)
            assert abs(expected) > 0.05  # Spark's binomial coefficients are Gosper's
            if few >= max(2, 0.75 * k) or expected < 0:
                want[a] = min(want.get(a, (0, 0.0, "")), (-len(shared), expected, b))
    assert told(spark, people) == {a: b for a, (_, _, b) in want.items()}
    assert any(max(len(beside[s]) for s in cores[a]) > n.SELECTIVE for a in want)


def test_the_ratio_alone_decides():
    # one length, one suffix, one forename; only the ratio tells them apart
    assert n.alike("dangelramman", "dalgelramman") and not n.alike("dangelramman", "dosgelramman")
    assert n.alike("lopez", "lopes") and n.alike("meyer", "meier") and n.alike("braun", "brauns")
    assert not n.alike("bell", "ball") and not n.alike("lee", "leo") and n.alike("", "")


def test_the_ratio_rejects_pairs_of_one_block(spark):
    found = entities(spark, ["Katharina Dangelramman", "Katharina Dalgelramman", "Katharina Dosgelramman"])
    assert found == [["Katharina Dalgelramman", "Katharina Dangelramman"], ["Katharina Dosgelramman"]]


WORDS = ["abcdefghijkl", "abcdefghijk", "abcdefghijlk", "xbcdefghijkl", "abcdefzhijkl", "abcdeghijkl", "qqqqqqqqqqqq", "short", "shart", "shor", "shorts", "hsort", "ab", "ba", "a", "abxdefghiykl", "z" * 70 + "a", "z" * 70, "y" + "z" * 70, "xy" * 60 + "q", "xy" * 60]


@pytest.mark.parametrize("common", [0, 2, 1000])
def test_blocks_of_any_bound_give_the_same_pairs(spark, common):
    df = spark.createDataFrame([("person", w) for w in WORDS], "kind string, core string")
    got = {(r.core, r.other) for r in n.near_cores(df, common).collect() if r.slips}
    slips = lambda a: {a[:i] + c + a[i + k :] for i in range(len(a) + 1) for k in (0, 1) for c in [*set("".join(WORDS)), ""]} | {a[:i] + a[i + 1 : i + 2] + a[i : i + 1] + a[i + 2 :] for i in range(len(a))}
    want = {(a, b) for a in WORDS for b in slips(a) & set(WORDS) if a != b and n.alike(a, b)}
    assert want <= got and all(n.alike(a, b) for a, b in got)


def test_components(spark):
    nodes = spark.createDataFrame([(f"{i:02}",) for i in range(30)], "node string")
    edges = spark.createDataFrame([(f"{i:02}", f"{i + 1:02}") for i in range(20)] + [("25", "24"), ("25", "25")], "a string, b string")
    got = {r.node: r.label for r in n.components(nodes, edges).collect()}
    assert got == {f"{i:02}": "00" if i <= 20 else "24" if i in (24, 25) else f"{i:02}" for i in range(30)}


@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
@settings(max_examples=300, deadline=None)
def test_common_letters(a, b):
    best = max((len(x) for k in range(len(a) + 1) for x in itertools.combinations(a, k) if is_part(x, b)), default=0)
    assert n.common_letters(a, b) == best


def is_part(letters, word):
    rest = iter(word)
    return all(c in rest for c in letters)


def test_ratio_and_parts():
    assert n.subsequence_ratio("abcd", "abxd") == 0.75 and n.subsequence_ratio("", "") == 1.0
    assert n.parse("Lerberren, K.") == n.Name(n.PERSON, "lerberren", "k")
    assert n.parse("a" * 3000).core == "a" * 3000
    assert [n.parse(x) for x in NOBODY] == [None] * len(NOBODY)
    assert n.same_given("katharina", "kath") and not n.same_given("theodora", "thomas")
