import math

import pytest

from poiloom.llm import quality as Q

SYMBOLS = set("#*$%&|<>")


def counts(text):
    w = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    seen: dict = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {p for v in seen.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    return (len(w), len(b"".join(w).decode()), sum(c in SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered), len(lines), sum(a == b for a, b in zip(w, w[1:], strict=False)))


def test_counts(docs, rows, empty):
    got = {r[0]: tuple(r)[1:-1] for r in Q.with_counts(docs, "doc_id").collect()}
    assert got == {r[0]: counts(r[1]) for r in rows}
    assert Q.with_counts(empty, "doc_id").count() == 0


def labelled(spark, n=12000):
    """Plain texts are good, every seventh one is full of symbols and mostly labelled bad."""
    word = "word{} than others are in this line of text here and there"
    rows = [(i, ("$$$ ### " if i % 7 == 0 else "") + word.format(i), "en" if i % 3 else "de") for i in range(n)]
    labels = [(i, int(i % 7 != 0 or i % 1400 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_hold(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r for r in Q.quality_rules(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == 12000
    for lang in (0, 1):
        good = [k for k in got if truth[k] == 1 and (k % 3 == 0) == (lang == 0)]
        assert sum(not got[k].kept for k in good) <= Q.ALLOWED * len(good)
    bad = [k for k in got if truth[k] == 0]
    assert sum(not got[k].kept for k in bad) >= 0.95 * len(bad)
    kept = Q.kept_documents(docs.selectExpr("*", "'a' as level", "1L as n_words", "true as kept"), labels)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k in got if got[k].kept) and kept.columns == ["doc_id", "text", "lang", "level", "n_words", "kept"]


def test_few_or_odd_labels(spark, docs, rows, empty):
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (7, None), (14, 5)], "doc_id long, quality int")
    for few in (labels, labels.limit(0)):
        got = Q.quality_rules(docs, few).collect()
        assert len(got) == len(rows)
        for r in got:
            n = counts(next(x[1] for x in rows if x[0] == r.doc_id))
            assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and r.kept == (not r.base_failed)
    assert Q.quality_rules(empty, labels).count() == 0


@pytest.mark.parametrize(("x", "n", "error"), [(0, 100, 0.05), (3, 50, 0.01), (10, 10, 0.05), (0, 0, 0.05), (7, 2000, 0.0125)])
def test_bound(x, n, error):
    p = Q.upper_bound(x, n, error)
    if x >= n:
        assert p == 1.0
        return
    tail = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x + 1))
    assert tail == pytest.approx(error, rel=1e-6)


def test_choose_stops_at_first_failure():
    L = Q.LEVELS
    assert Q.choose([(False, 1, L, 5000), (False, 1, 3, 500), (True, 0, 0, 10), (True, 0, 2, 90)], 2) == 2
    assert Q.choose([(False, 1, L, 5)], 2) is None


def test_kept_by_loops(spark, monkeypatch):
    """Paths, levels and verdicts made anew by loops over the labelled documents."""
    monkeypatch.setattr(Q, "ALLOWED", 0.04)  # some level is certified with so few labels
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    # few strata with many labels, so that some level is certified
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 4 > 0, F.lit("a")))
    more = docs.unionByName(docs.withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.concat("text", F.lit(" end"))}))
    for k in range(4):
        more = more.unionByName(docs.withColumns({"doc_id": F.col("doc_id") + 10**7 * (k + 1), "text": F.concat("text", F.lit(f" tail{k}"))}))
    own = labels.select("doc_id", "quality")
    every = own
    for shift in (10**6, *(10**7 * (k + 1) for k in range(4))):
        every = every.unionByName(own.select((F.col("doc_id") + shift).alias("doc_id"), "quality"))
    counted = Q.ruled(Q.with_counts(more, "doc_id", "lang")).withColumn("first", F.pmod(F.xxhash64(F.lit(7), F.col(Q.HASH)), F.lit(2)) == 0).collect()
    label = {r.doc_id: r.quality for r in every.collect()}
    names = Q.rules_names()
    cut: dict = {}
    for lang in ("a", None):
        mine = [r for r in counted if r.lang == lang and not r.base_failed and label.get(r.doc_id) in (0, 1)]
        good = [r for r in mine if r.first and label[r.doc_id] == 1]
        bad = [r for r in mine if r.first and label[r.doc_id] == 0]
        paths = {}
        for n in names:
            values = sorted({r[n] for r in good + bad})
            path = [min(v for v in values if sum(r[n] > v for r in good) <= len(good) * (Q.ALLOWED * k / Q.LEVELS)) for k in range(Q.LEVELS)]
            lost = sum(r[n] > path[-1] for r in bad)
            if bad and Q.lower_bound(lost, len(bad), 1 - Q.USEFUL) > Q.ALLOWED:
                paths[n] = path
        level = lambda r: min([next((k for k, v in enumerate(p) if r[n] > v), Q.LEVELS) for n, p in paths.items()], default=Q.LEVELS)  # noqa: B023, E731
        held = [level(r) for r in mine if not r.first and label[r.doc_id] == 1]
        certified = -1
        for k in range(Q.LEVELS):
            if Q.upper_bound(sum(x <= k for x in held), len(held), Q.ERROR / 2) > Q.ALLOWED:
                break
            certified = k
        gone = [level(r) for r in bad]
        take = next((k for k in range(Q.LEVELS) if sum(x <= k for x in gone) >= Q.NEARLY * sum(x <= certified for x in gone)), None) if certified >= 0 else None
        cut[lang] = (take, level, paths)
    want = {r.doc_id: not r.base_failed and (cut[r.lang][0] is None or cut[r.lang][1](r) > cut[r.lang][0]) for r in counted}
    got = {r.doc_id: r.kept for r in Q.quality_rules(more, every).collect()}
    assert cut["a"][2] and cut["a"][0] is not None
    assert got == want
