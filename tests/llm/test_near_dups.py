import random

import numpy as np
import pytest

from poiloom.llm import near_dups as N
from poiloom.llm import words as W
from poiloom.llm.components import components


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(rows):
    """Smallest id of each document's class, by comparing all."""
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {r[0]: shingles(r[1]) for r in rows}
    for a in sets:
        for b in sets:
            if a < b:
                x, y = sets[a], sets[b]
                if (not x and not y) or (x and y and len(x & y) / len(x | y) >= 0.8):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {k: find(k) for k in root}


def test_classes(docs, rows, empty):
    got = {r.doc_id: r.class_id for r in N.near_classes(docs).collect()}
    assert got == classes(rows)
    kept = N.first_of_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert N.near_classes(empty).count() == 0 and N.first_of_class(empty).count() == 0


def test_chain_of_near_copies(spark):
    """Each one is near the next only, so leaders of a bucket don't link them all."""
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 10**9)}" for _ in range(200)]
    rows = []
    for i in range(12):
        rows.append((100 - i, " ".join(words)))
        for k in rng.sample(range(200), 3):
            words[k] = f"x{rng.randint(0, 10**9)}"
    rows += [(500, None), (501, ""), (None, "no id at all here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in N.near_classes(df).collect()}
    assert got == classes(rows[:-1])


def test_triples_whose_smallest_id_is_not_the_hub(spark):
    """The smallest id is near the hub only, and often both leaders of all buckets that the other two share."""
    rng = random.Random(12)
    rows = []
    for i in range(0, 600, 3):
        hub = [f"w{rng.randint(0, 10**9)}" for _ in range(304)]
        first, last = list(hub), list(hub)
        first[20] = f"x{i}"
        for k in range(60, 300, 40):
            last[k] = f"y{i}-{k}"
        first[280] = f"x{i}-280"
        rows += [(i, " ".join(first)), (i + 1, " ".join(hub)), (i + 2, " ".join(last))]
    near = [len(a & b) / len(a | b) for a, b in ((shingles(rows[p][1]), shingles(rows[q][1])) for p, q in ((0, 1), (1, 2), (0, 2)))]
    assert near[0] >= 0.9 and 0.8 <= near[1] < 0.85 and near[2] < 0.8
    got = {r.doc_id: r.class_id for r in N.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k - k % 3 for k in got} and len(got) == 600


def test_names_as_ids_and_equal_ids(spark):
    """Ids of any type; rows with equal ids and other texts are documents of their own, with equal texts one document."""
    rng = random.Random(4)
    text = [" ".join(f"w{rng.randint(0, 10**9)}" for _ in range(120)) for _ in range(4)]
    near = [t + " more" for t in text]
    rows = [("b", text[0]), ("a", near[0]), ("é", text[1]), ("Z", text[1]), ("x", text[2]), ("x", text[2]), ("x", text[3]), ("y", near[3]), (None, text[2])]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = sorted((r.doc_id, r.copy_of, r.class_id) for r in N.near_classes(df).collect())
    assert got == sorted([("a", "a", "a"), ("b", "b", "a"), ("é", "Z", "Z"), ("Z", "Z", "Z"), ("x", "x", "x"), ("x", "x", "x"), ("x", "x", "x"), ("y", "y", "x")])
    kept = sorted((str(r.doc_id), text.index(r.text) if r.text in text else -1) for r in N.first_of_class(df).collect())
    assert kept == [("None", 2), ("Z", 1), ("a", -1), ("x", 2), ("x", 3)]


def test_leaders_of_many(spark, monkeypatch):
    """More partners than a chunk holds."""
    monkeypatch.setattr(N, "CHUNK", 8)
    rng = random.Random(7)
    hub = [f"w{rng.randint(0, 10**9)}" for _ in range(300)]
    rows = []
    for i in range(90):
        own = list(hub)
        for k in rng.sample(range(300), rng.randint(0, 9)):
            own[k] = f"x{i}-{k}"
        rows.append((1000 - i, " ".join(own)))
    got = {r.doc_id: r.class_id for r in N.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes(rows)


def test_recall_on_a_corpus(spark):
    """Every link that comparing all finds is within a class, and no class holds more than links explain."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = {k: shingles(t) for k, t in rows}
    where: dict = {}
    for k, own in sets.items():
        for x in own:
            where.setdefault(x, []).append(k)
    common: dict = {}
    for ks in where.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in common.items() if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8]
    got = {r.doc_id: r.class_id for r in N.near_classes(docs).collect()}
    assert len(links) > 50 and sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links)
    linked = {k for link in links for k in link}
    assert sum(v != k and k not in linked and bool(sets[k]) for k, v in got.items()) <= 0.01 * len(got)


def test_estimates():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    errors = []
    for _ in range(20):
        a = [rng.choice(words) for _ in range(300)]
        b = a[: rng.randint(50, 300)] + [rng.choice(words) for _ in range(60)]
        doc, run, weight = N.bags([[x.encode() for x in a], [x.encode() for x in b]])
        s = N.signatures(doc, run, weight, 2)
        bags = [(run[doc == k], weight[doc == k]) for k in (0, 1)]
        errors.append((s[0] == s[1]).mean() - N.likeness(*bags))
        alone = N.signatures(*N.bags([[x.encode() for x in b]]), 1)
        assert (alone[0] == s[1]).all()
    assert abs(np.mean(errors)) < 0.03 and max(map(abs, errors)) < 0.2


def test_weighted_likeness():
    a = (np.array([1, 2, 3], dtype=np.uint64), np.array([1, 2, 1]))
    b = (np.array([2, 3, 4], dtype=np.uint64), np.array([1, 1, 3]))
    own, other = dict(zip(*a, strict=True)), dict(zip(*b, strict=True))
    want = sum(1 / sum(max(own.get(j, 0) / own[d], other.get(j, 0) / other[d]) for j in own | other) for d in own.keys() & other.keys())
    assert N.likeness(a, b) == pytest.approx(max(want, 0.5))
    assert N.likeness(N.bag(""), N.bag(None)) == 1.0 and N.likeness(N.bag("a"), N.bag("")) == 0.0


@pytest.mark.parametrize("local", [0, 1 << 18])
def test_components(spark, monkeypatch, local):
    from poiloom.llm import components as C

    monkeypatch.setattr(C, "LOCAL_EDGES", local)
    rng = random.Random(8)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 260)] + [(5, 5)]
    root: dict = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {k: find(k) for k in root}
    pairs = df.selectExpr("struct(concat('n', lpad(u, 4, '0')) as id, u as h) as u", "struct(concat('n', lpad(v, 4, '0')) as id, v as h) as v")
    assert {r.node.h: r.root.h for r in components(pairs).collect()} == got
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_windows_depend_on_order_only():
    h = W.hashes([b"a", b"b", b"c", b"a", b"b", b"c", b"x"])
    for width in range(1, 8):
        w = W.windows(h, width)
        assert len(w) == 8 - width
        if width <= 3:
            assert w[0] == w[3]
    assert W.windows(h, 9).size == 0
    assert W.windows(h.reshape(1, 7), 3)[0].tolist() == W.windows(h, 3).tolist()
