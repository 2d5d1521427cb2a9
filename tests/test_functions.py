import difflib
import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from poiloom.functions import geo, hours
from poiloom.functions import text as T
from poiloom.functions.fuzzy import common_length, token_set_similarity


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expr(F.col("v"))).orderBy("i").collect()]


def test_normalized_name(spark):
    names = ["  Café Ñandú ", None, "\tx ", "straße", "한국 Café", " é\x1f", "İz", "", "  "]

    def expected(s):
        if s is None:
            return None
        s = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
        return s.upper().strip()

    assert column(spark, names, lambda c: T.normalized_name(c, True)) == [expected(s) for s in names]


def test_name_keys(spark):
    assert column(spark, ["Sam`s  Club", "L’Été", None], T.filter_key) == ["sam's  club", "l'été", None]
    assert column(spark, [" Weiß\t Bär  ", "Łódź", None], T.spatial_name) == ["weiss bar", "lodz", None]
    assert column(spark, [" Weiß  Bär ", "el DJ inn"], T.keyword_name) == ["weiss  bar", "el dj inn"]


def test_chain_patterns(spark):
    from poiloom.sources.packs import chain_patterns

    p = T.any_pattern(chain_patterns("MX"))
    names = ["OXXO Centro", "ROXXO", "Veterinaria Sol", "sam's club", "baño", None, "BODEGA AURRERA"]
    assert column(spark, names, lambda c: T.matches(T.filter_key(c), p)) == [True, False, True, True, False, False, True]
    with pytest.raises(ValueError):
        chain_patterns("xx")


def test_pattern_flags(spark):
    assert column(spark, ["BAÑOS", "ñbaño"], lambda c: T.matches(c, T.any_pattern([r"\bbaño\w*"]))) == [True, False]


def test_trie_equals_alternation(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcé .&-") for _ in range(rng.randint(1, 5))).strip() for _ in range(120)} - {""})
    trie = re.compile(T.trie_pattern(words, r"\s*"))
    plain = re.compile("|".join(re.escape(w).replace(r"\ ", r"\s*") for w in words))
    texts = ["".join(rng.choice("abcé .&-") for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    assert [bool(trie.search(t)) for t in texts] == [bool(plain.search(t)) for t in texts]


def test_keyword_pattern_equals_list(spark):
    keywords = ["100 Montaditos", "Acrílico", "#NAME?", "Zoo", "a (b|c) d", "Mérida|Centro", "Barber"]
    names = ["100Montaditos", "acrilicos", "ACRÍLICO sa", "#NAME?", "x#NAME", "zoológico", "a b d", "cercaMéridas", "kein", "Barbershop", None]
    variants = T.keyword_variants(keywords)
    one = [r"\b" + re.sub(r"\(([^)]+)\)", r"(?:\1)", k).replace(" ", r"\s*") + r"\w*" for k in variants]
    rx = re.compile("|".join(one), re.IGNORECASE)
    assert column(spark, names, lambda c: T.matches(c, T.keyword_pattern(variants))) == [bool(n and rx.search(n)) for n in names]


def test_first_keyword(spark):
    assert column(spark, ["xZOOy bar", "bar", "none", None], lambda c: T.first_keyword(c, ["Bar", "zoo"])) == ["Bar", "Bar", None, None]


@pytest.mark.parametrize(
    ("day", "length", "start"),
    [
        ("09:00-18:00", 9.0, 9.0), ("22:00-02:00", 4.0, 22.0), ("09:00-09:00", None, 9.0), ("00:00-00:00", None, None), ("09:00-13:00, 15:00-18:00", None, None), ("9:00 AM-5:00 PM", None, None),
        ("Not available", None, None), (None, None, None), ("", None, None), (" 8:30 - 9:00 ", 0.5, 8.5), ("20:00-xx", None, 20.0), ("nan", None, None), ("25:00-26:30", 1.5, 25.0),
    ],
)
def test_hours(spark, day, length, start):
    df = spark.createDataFrame([(day,)], "v string").select(hours.duration(F.col("v")), hours.opening(F.col("v")))
    assert tuple(df.first()) == (length, start)


def test_week(spark):
    rows = [("09:00-13:00",) * 5 + (None, None), ("19:00-23:00", "20:00-21:00") + (None,) * 5, ("18:59-23:00",) + ("20:00-23:00",) * 6, (None,) * 7]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"d{k} string" for k in range(7)))
    days = [F.col(f"d{k}") for k in range(7)]
    got = df.orderBy("i").select(hours.weekly_hours(days), hours.night_only(days, 19)).collect()
    assert [tuple(r) for r in got][:2] == [(20.0, False), (5.0, True)]
    assert got[2][1] is False and tuple(got[3]) == (None, None)


def test_token_sets():
    assert token_set_similarity("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert token_set_similarity("a b", "b a c") == 100
    assert token_set_similarity("", "a") == 0
    assert token_set_similarity(None, "a") == 0
    assert token_set_similarity("mariners vs angels", "los angeles angels of anaheim at seattle mariners") == pytest.approx(90.909, abs=0.01)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_common_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert common_length(a, b) == table[-1][-1]
    assert token_set_similarity(a, b) == token_set_similarity(b, a)
    assert difflib.SequenceMatcher(None, a, b).ratio() <= 1


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.haversine(*[F.col(c) for c in "abcd"])).collect()]
    assert got[0] == pytest.approx(111194.93, abs=0.01) and got[1] is None


def test_other_scripts(spark):
    from poiloom.functions import text as T

    names = ["Кафе Ёлка", "ЩУКА Объект", "Καφέ Ψωμί", "ΆΓΙΟΣ", "Жук-й", "北京 x"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(T.to_ascii(F.col("n"))).collect()]
    assert got == ["Kafe Iolka", "ShchUKA Obekt", "Kaphe Psomi", "AGIOS", "Zhuk-i", "北京 x"]


def test_keywords_as_patterns():
    from poiloom.functions import text as T

    assert T.own_pattern("a (b c) d") == r"a\s*(?:b\s*c)\s*d"
    assert T.own_pattern(r"a\ b()") == r"a\s*b()" and T.own_pattern("x(y") == "x(y" and T.own_pattern("((a) b)") == r"(?:(a)\s*b)"
