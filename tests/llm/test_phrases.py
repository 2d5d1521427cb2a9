import hashlib
import random

import numpy as np
import pytest

from poiloom.llm import phrases as P


def edit(rows):
    own = sorted((r[0], r[1] or "") for r in rows)
    out = {}
    for i, (k, t) in enumerate(own):
        following = own[(i + 1) % len(own)][1]
        n = len(t) // 4
        out[k] = (t, t[: len(t) - n] + following[:n], following)
    return out


def test_fingerprints(docs, rows, empty):
    got = {r.doc_id: r for r in P.fingerprints(docs).collect()}
    want = edit(rows)
    assert got.keys() == want.keys()
    prints: dict = {}
    for k, (text, changed, following) in want.items():
        r = got[k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = P.sketches([text.encode(), changed.encode(), following.encode()])
        assert (r.fingerprint, r.edited_fingerprint) == (P.shown(a), P.shown(b))
        assert r.near_edited == P.likeness(a, b) and r.near_next == P.likeness(a, c)
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    long = [r.near_edited for r in got.values() if r.n_chars > 400 and len(set(want[r.doc_id][0].split())) > 30]
    assert 0.45 < np.mean(long) < 0.75
    assert P.fingerprints(empty).count() == 0


def test_neighbours_across_blocks(spark):
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 300)))) for k in rng.sample(range(-5000, 5000), 40)]
    got = {r.doc_id: r.edited_sha256 for r in P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {k: hashlib.sha256(v[1].encode()).hexdigest() for k, v in edit(rows).items()}
    one = P.fingerprints(spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0
    ties = [(1, "b" * 8), (1, "a" * 8), (None, "c" * 8)]
    got = P.fingerprints(spark.createDataFrame(ties, "doc_id long, text string")).collect()
    assert {r.edited_sha256 for r in got} == {hashlib.sha256(x).hexdigest() for x in (b"ccccccaa", b"aaaaaabb", b"bbbbbbcc")}


@pytest.mark.parametrize("shift", [1, 5, 13])
def test_phrases_are_the_same_at_any_offset(shift):
    rng = random.Random(shift)
    text = bytes(rng.choice(b"abcdefghij  ") for _ in range(4000))
    names = []
    for raw in (text, bytes(rng.choice(b"xyz") for _ in range(shift)) + text):
        x, start = np.frombuffer(raw, dtype=np.uint8), np.array([0])
        for _ in range(3):
            x, start = P.parse(x, start)
        names.append(x)
    a, b = set(names[0].tolist()), set(names[1].tolist())
    assert len(a & b) >= 0.95 * len(a)
    assert 4000 / 90 < len(names[0]) < 4000 / 8


def test_labels_differ_and_are_small():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    start = np.array([0, 700, 701, 2000])
    own = P.labels(x, start)
    inner = np.setdiff1d(np.arange(1, len(x)), np.concatenate([start, start + 1, start + 2, start + 3]))
    assert own[inner].max() < 8 and (own[inner] != own[inner - 1]).all()


def test_texts_do_not_touch_each_other():
    raws = [b"", b"a", b"aaaaaaaaaaaa", b"abcabcabc" * 40, b"z", "ünï".encode() * 30]
    together = P.sketches(raws)
    for raw, s in zip(raws, together, strict=True):
        assert P.shown(P.sketches([raw])[0]) == P.shown(s)
    none = P.sketches([b""])[0]
    assert P.likeness(none, none) == 1.0 and P.likeness(none, together[3]) == 0.0
