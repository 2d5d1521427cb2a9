import re

import pytest

from poiloom.llm import mixing


def brute(rows):
    sizes = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    total: dict = {}
    for r in rows:
        total[r[3]] = total.get(r[3], 0) + sizes[r[0]]
    return sizes, total


def goals(spark, sizes):
    df = spark.createDataFrame([(k, v, 1) for k, v in sizes.items()], "name string, source_size long, rows long")
    return {r["name"]: r.target for r in mixing.targets(df).collect()}


def test_mix(spark, docs, rows):
    sizes, total = brute(rows)
    got = mixing.mix_words(docs).collect()
    goal = goals(spark, total)
    source = {r[0]: r[3] for r in rows}
    taken: dict = {}
    assert len(got) == len(rows)
    for r in got:
        assert r["size"] == sizes[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(goal[source[r.doc_id]]) and 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    for s, g in goal.items():
        assert abs(taken[s] - g) <= 3 * max(sizes[r[0]] for r in rows if r[3] == s)
    again = mixing.mix_words(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_targets(spark):
    t = goals(spark, {"a": 10, "b": 100, "c": 100, None: 5})
    assert t["a"] == 30 and t[None] == 15 and sum(t.values()) == pytest.approx(215)
    assert t["b"] == pytest.approx(2 * t["c"])
    assert goals(spark, {}) == {} and goals(spark, {"a": 0})["a"] == 0
    t = goals(spark, {"Z": 9, "z": 9, "é": 9})
    assert t["Z"] > t["z"] > t["é"]


def test_many_sources(spark):
    # shares that are cut off step by step, against exact fractions
    from fractions import Fraction

    sizes = {f"s{i:04d}": (i * i * 7919) % 1000 + i for i in range(300)}
    names, weight = sorted(sizes), {n: (5, 2, 1)[i % 3] for i, n in enumerate(sorted(sizes))}
    full: set = set()
    while True:
        left, shared = sum(sizes.values()) - 3 * sum(sizes[n] for n in full), sum(weight[n] for n in names if n not in full)
        new = {n for n in names if n not in full and Fraction(left * weight[n], shared) > 3 * sizes[n]}
        if not new:
            break
        full |= new
    got = goals(spark, sizes)
    assert full and all(got[n] == pytest.approx(3 * sizes[n] if n in full else left * weight[n] / shared) for n in names)


def test_seeds(spark, docs):
    sized = docs.selectExpr("doc_id", "source", "coalesce(length(text), 0) as size")
    found = [tuple(sorted((r.doc_id, r.copies) for r in mixing.mix(sized, seed=s).collect())) for s in (1, 2, 3, 3)]
    assert len(set(found)) == 3 and found[2] == found[3]


def test_equal_rows(spark):
    # equal ids with other texts keep their own numbers; rows that are equal throughout are interchangeable
    rows = [(1, f"w{i} " * (i % 9 + 1), "ab"[i % 2], i) for i in range(40)] + [(2, "same words", "a", 1)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(3)
    taken: dict = {}
    for r in mixing.mix_words(df).collect():
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
    got: dict = {}
    for r in mixing.mixed_documents(df).collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert sorted(got.values()) == sorted(taken.values())


def test_documents(docs, rows, empty):
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix_words(docs).collect()}
    seen: dict = {}
    for r in got.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert {k: v for k, v in seen.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mix_words(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
