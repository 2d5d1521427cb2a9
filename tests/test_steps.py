import random

import pytest
from pyspark.sql import functions as F

from poiloom.functions.fuzzy import token_set_similarity
from poiloom.functions.hours import DAYS
from poiloom.operators import dedup as D
from poiloom.operators import steps as S
from poiloom.operators.spatial import radius_pairs, suppressed


def points(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, name string, latitude double, longitude double, dataplor_id string")


def ids(df):
    return sorted(r[0] for r in df.select("row_id").collect())


def test_keep_policies(spark):
    df = spark.createDataFrame([(0, "a", None), (1, "a", None), (2, "b", 1.0), (3, None, 1.0)], "row_id long, k string, x double")
    assert ids(D.deduplicate(df, ["k", "x"])) == [0, 2, 3]
    assert ids(D.deduplicate(df, ["k", "x"], "last")) == [1, 2, 3]
    assert ids(D.deduplicate(df, ["k", "x"], "none")) == [2, 3]
    assert len(ids(D.deduplicate(df, ["k", "x"], "any"))) == 3
    with pytest.raises(ValueError):
        D.deduplicate(df, ["nope"])
    with pytest.raises(ValueError):
        D.deduplicate(df, ["k"], "best")


def test_drops(spark):
    before = spark.createDataFrame([(0, "a", 1.0), (1, "b", None), (2, "c", 2.0)], "row_id long, name string, latitude double")
    after = before.where("row_id < 2")
    assert ids(D.exact_drops(before, after)) == [2]
    assert ids(D.legacy_drops(before, after)) == [1, 2]
    assert D.report_drops(before, after).count() == 2


def test_normalize_and_dedup(spark):
    df = points(spark, [("Café", 1.0, 1.0, "x"), ("cafe ", 1.0, 1.0, "y"), ("Café", 2.0, 1.0, "z"), (None, None, None, "n"), (None, None, None, "m")])
    r = S.normalize_and_dedup(df)
    assert ids(r.kept) == [0, 2, 3] and r.kept.columns[:2] == ["name", "name_normalized"]
    assert {x[0] for x in r.dropped.select("drop_reason").collect()} == {"Exact_Duplicate"}


def test_chains(spark):
    rows = [(0, "OXXO CENTRO", "False"), (1, "TIENDA", "True"), (2, "TIENDA", "true"), (3, "TIENDA", None), (4, None, None)]
    df = spark.createDataFrame(rows, "row_id long, name_normalized string, identified_as_chain string")
    assert ids(S.remove_chains(df, [r"\boxxo\b"]).kept) == [3, 4]
    assert ids(S.remove_chains(df, [r"\boxxo\b"], strict_flag=True).kept) == [2, 3, 4]
    rows = {r["row_id"]: r["drop_reason"] for r in S.remove_chains(df, [r"\boxxo\b"], True, 2).rows.collect()}
    assert rows == {0: "1_Regex_Chain", 1: "2_Too_Many_Duplicates_(>2)", 2: "2_Too_Many_Duplicates_(>2)", 3: "2_Too_Many_Duplicates_(>2)", 4: None}
    twice = S.remove_chains(S.remove_chains(df, [r"\boxxo\b"]).kept, [r"\boxxo\b"]).kept
    assert ids(twice) == [3, 4]


def test_geo_dedup(spark):
    rows = [("A", 10.0, 10.0, "a"), ("a ", 10.0001, 10.0, "b"), ("A", 20.0, 20.0, "c"), ("Á", 20.0, 20.0001, "d"), ("A", 50.0, 5.0, "e"), ("A", None, None, "b"), ("B", 10.0, 10.0, "f"), ("C", 1.0, 1.0, "g"), ("C", 1.0, 1.0, "g"), (None, 2.0, 2.0, "h"), (None, 2.0, 2.0, "i")]
    df = points(spark, rows)
    assert ids(S.geo_dedup(df).kept) == [0, 4, 6, 7, 8, 9]
    assert ids(S.geo_dedup(df, scope="cluster").kept) == [0, 2, 4, 6, 9]


def naive_distance(a, b):
    from math import asin, cos, radians, sin, sqrt

    x = sin((radians(a[0]) - radians(b[0])) / 2) ** 2 + cos(radians(a[0])) * cos(radians(b[0])) * sin((radians(a[1]) - radians(b[1])) / 2) ** 2
    return 2 * 6371000.0 * asin(sqrt(min(1.0, x)))


def test_radius_pairs_everywhere(spark):
    rng = random.Random(5)
    places = [(rng.uniform(-0.004, 0.004) + c, rng.uniform(-0.004, 0.004) + d) for c, d in ((0, 179.999), (0, -179.999), (60, 10), (-89.995, 50), (89.2, -120), (19.4, -99.1)) for _ in range(60)]
    places = [(a, (b + 180) % 360 - 180) for a, b in places]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(places)], "row_id long, latitude double, longitude double")
    got = {(r["i"], r["j"]) for r in radius_pairs(df, 150.0).collect()}
    want = {(i, j) for i in range(len(places)) for j in range(i + 1, len(places)) if naive_distance(places[i], places[j]) <= 150.0}
    assert got == want and len(want) > 50


def test_suppression_follows_row_order(spark):
    rng = random.Random(7)
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(120)})
    gone = set()
    for i in range(60):
        if i not in gone:
            gone |= {j for a, j in edges if a == i}
    got = {r[0] for r in suppressed(spark.createDataFrame(edges, "i long, j long")).collect()}
    assert got == gone
    assert suppressed(spark.createDataFrame([], "i long, j long")).count() == 0


@pytest.mark.parametrize("tiles", [1, 3, 40])
def test_suppression_across_tiles(spark, tiles):
    """A chain through all tiles, and edges between any of them."""
    rng = random.Random(tiles)
    edges = sorted({(i, i + 1) for i in range(70)} | {tuple(sorted(rng.sample(range(200), 2))) for _ in range(250)})
    gone = set()
    for i in range(200):
        if i not in gone:
            gone |= {j for a, j in edges if a == i}
    df = spark.createDataFrame([(i, j, j * 7919 % tiles) for i, j in edges], "i long, j long, tile_j long")
    assert {r[0] for r in suppressed(df).collect()} == gone


def test_many_copies_of_a_place(spark):
    """Copies make no pairs: 5000 rows of one name and place, with other ids, some near them and some far."""
    rows = [("A", 10.0, 10.0, f"x{i}") for i in range(5000)] + [("A", 10.0001, 10.0, "near"), ("A", 30.0, 10.0, "far"), ("A", 40.0, 10.0, "far2"), ("A", 40.0, 10.0, "far2")]
    df = points(spark, rows)
    assert ids(S.geo_dedup(df).kept) == [0, 5001]
    assert ids(S.geo_dedup(df, scope="cluster").kept) == [0, 5001]


def test_bound_of_similarity(spark):
    from poiloom.functions.fuzzy import name_words, score_bound

    rng = random.Random(3)
    words = ["sol", "luna", "mar", "casa", "rio", "la", "x", "tienda", "ñandú"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 5))), "  ".join(rng.choices(words, k=rng.randint(0, 5)))) for _ in range(400)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", score_bound(name_words("a"), name_words("b")).alias("most")).collect()
    assert all(r.most >= token_set_similarity(r.a, r.b) - 1e-9 for r in got)
    assert sum(r.most < 80 for r in got) > 100


def test_hours_and_fuzzy_against_loop(spark):
    rng = random.Random(11)
    words = ["sol", "luna", "mar", "casa", "rio"]
    rows = [(i, " ".join(rng.sample(words, rng.randint(1, 3))), 10 + rng.uniform(0, 0.002), 10 + rng.uniform(0, 0.002)) for i in range(80)]
    rows += [(80, rows[3][1], rows[3][2], rows[3][3]), (81, rows[3][1], rows[3][2], rows[3][3]), (82, None, 10.0, 10.0), (83, "sol", None, None)]
    df = spark.createDataFrame(rows, "row_id long, name string, latitude double, longitude double")
    df = df.withColumns({f"{d}_hours": F.lit("09:00-18:00") for d in DAYS})
    gone = set()
    for a in rows:
        if a[0] not in gone and a[1] is not None and a[2] is not None:
            gone |= {b[0] for b in rows if b[0] > a[0] and b[1] is not None and b[2] is not None and naive_distance(a[2:], b[2:]) <= 100 and token_set_similarity(a[1], b[1]) >= 80}
    r = S.hours_and_fuzzy(df)
    assert ids(r.dropped) == sorted(gone) and len(gone) > 10
    assert {x[0] for x in r.dropped.select("drop_reason").collect()} == {"3_Fuzzy_Dedup"}


def test_hours_and_keywords(spark):
    week = [("09:00-13:00",) * 5 + (None,) * 2, ("09:00-12:54",) * 5 + (None,) * 2, (None,) * 7, ("19:00-23:00",) * 7]
    rows = [(i, "x", None, None, *w) for i, w in enumerate(week)] + [(4, "Funerarias Paz", None, None, *week[0]), (5, "el djinn", None, None, *week[0]), (6, "DJ", None, None, *week[0])]
    df = spark.createDataFrame(rows, "row_id long, name string, latitude double, longitude double, " + ", ".join(f"{d}_hours string" for d in DAYS))
    got = {r["row_id"]: r["drop_reason"] for r in S.hours_and_fuzzy(df).rows.collect()}
    assert got == {0: None, 1: "2_Hours_Filter", 2: "2_Hours_Filter", 3: "2_Hours_Filter", 4: "1_Global_Keywords", 5: "1_Global_Keywords", 6: None}


def test_final_keywords(spark):
    names = ["Barbershop", "#NAME?", "100Montaditos", None, "Zapateria Luz", "Peluca"]
    df = spark.createDataFrame(list(enumerate(names)), "row_id long, name string")
    r = S.final_keywords(df, ["Barber", "#NAME?", "100 Montaditos", "Zapateria", "Peluca"])
    assert {x["row_id"]: x["drop_reason"] for x in r.dropped.collect()} == {4: "1_Final_Regex_Keyword_(Zapateria)", 5: "1_Final_Regex_Keyword_(Peluca)"}
    assert S.final_keywords(df, []).kept.count() == 6


def test_crowded(spark):
    near = [(10.0 + k * 1e-5, 10.0, "P") for k in range(4)]
    far = [(20.0, 20.0, "Q")] * 3 + [(20.01, 20.0, "Q")]
    rows = near + far + [(30.0, 30.0, None)] * 4 + [(None, None, "P")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, latitude double, longitude double, parent_location string")
    assert ids(S.crowded_property(df).dropped) == [0, 1, 2, 3]
    assert S.crowded_property(df.drop("parent_location")).kept.count() == len(rows)


def test_empty_tables(spark):
    df = points(spark, []).withColumns({f"{d}_hours": F.lit(None).cast("string") for d in DAYS}).withColumn("parent_location", F.lit("x"))
    named = S.normalize_and_dedup(df).kept
    for r in (S.remove_chains(named, ["a"]), S.geo_dedup(named), S.hours_and_fuzzy(named), S.final_keywords(named, ["a"]), S.crowded_property(named)):
        assert r.kept.count() == 0


def test_rows_are_joined_by_shuffle(spark):
    """However small the files look, sides with a row for each place aren't sent through the driver."""
    df = points(spark, [("Sol", 1.0, 1.0, "x"), ("sol ", 1.0, 1.0, "y"), ("Sol", 2.0, 1.0, "z")])
    first = S.normalize_and_dedup(df)
    alike = S.fuzzy_edges(df.withColumnRenamed("name", "_name"))
    # the last join of the step; what it wrote before is read here
    judged = S.hours_and_fuzzy(df.withColumns({f"{d}_hours": F.lit("09:00-18:00") for d in DAYS}))
    for x in (D.deduplicate(df, ["name"]), D.deduplicate(df, ["name"], "none"), first.rows, alike, judged.rows):
        assert "Broadcast" not in x._jdf.queryExecution().executedPlan().toString()
    assert ids(first.kept) == [0, 2] and ids(judged.dropped) == [1]
