import collections
import hashlib
import random

import numpy as np
import pytest

from poiloom.llm import blobs as B
from poiloom.llm import substrings, suffixes
from poiloom.llm import words as W


def words_kept(rows, window):
    lists = {r[0]: (r[1] or "").encode().split() for r in rows}
    times = collections.Counter(tuple(w[i : i + window]) for w in lists.values() for i in range(len(w) - window + 1))
    out = {}
    for k, w in lists.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out[k] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return out


def bytes_kept(rows, window):
    seen, out = set(), {}
    for k, raw in sorted((r[0], (r[1] or "").encode()) for r in rows):
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - window + 1):
            if raw[i : i + window] in seen:
                gone[i : i + window] = True
            seen.add(raw[i : i + window])
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        out[k] = (len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("window", [35, 7])
def test_words(docs, rows, window):
    got = {r.doc_id: (r["n_words"], r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs, window).collect()}
    assert got == words_kept(rows, window)
    assert sum(v[1] for v in got.values()) > 0


@pytest.mark.parametrize("window", [100, 66])
def test_bytes(docs, rows, window):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_seen(docs, window).collect()}
    assert got == bytes_kept(rows, window)
    assert sum(v[1] for v in got.values()) > 0


def test_many_blocks(spark):
    """Passages that meet at any offset, across blocks of documents, negative ids included."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = []
    for i in range(60):
        own = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(20, 90)))
        cut = rng.randint(0, len(own))
        a = rng.randint(0, len(passage) - 200)
        rows.append(((i - 20) * 301, own[:cut] + passage[a : a + rng.randint(90, 400)] + own[cut:]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_seen(df).collect()} == bytes_kept(rows, 100)
    assert {r.doc_id: (r["n_words"], r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(df).collect()} == words_kept(rows, 35)


def test_repeated_rows_and_null_ids(spark, empty):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, text), (1, text), (None, "x")], "doc_id long, text string")
    assert sorted(r.n_removed for r in substrings.remove_repeats(df).collect()) == [0, 50, 50]
    assert sorted(r.n_removed for r in suffixes.remove_seen(df).collect()) == [0, 0, len(text)]
    assert substrings.remove_repeats(empty).count() == 0 and suffixes.remove_seen(empty).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_seen(df, 20)


def test_shared_fingerprints(docs, rows):
    def weak_prints(raw, places, width):  # many strings share one
        return suffixes.byte_prints(raw, places, width) >> np.uint64(60) << np.uint64(60)

    def weak_hashes(words):  # one of two takes few values
        h = W.wide_hashes(words)
        return np.stack([h[0] % np.uint64(2), h[1]])

    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_seen(docs, prints=weak_prints).collect()}
    assert got == bytes_kept(rows, 100)
    got = {r.doc_id: (r["n_words"], r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs, hashes=weak_hashes).collect()}
    assert got == words_kept(rows, 35)


def spread_rows():
    """Passages in most blocks of documents, with other surroundings each time, cut at all lengths; zero bytes and runs."""
    rng = random.Random(8)
    line = "A line that stands in very many documents, under the same licence, as is, without any warranty of any kind, express or implied. "
    rows = []
    for i in range(120):
        own = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(5, 40)))
        cut, a = rng.randint(0, len(own)), rng.randint(0, 60)
        rows.append((i * 10_000_019, own[:cut] + line[a : rng.randint(a, len(line))] + rng.choice(["", "\x00" * 30, "z" * 150, line]) + own[cut:]))
    rows += [(None, line + "x"), (None, line + "y"), (None, None), (7, "\x00" * 120), (8, "\x00" * 99), (9, "\x00" * 101 + "a")]
    return rows


@pytest.mark.parametrize("hot", [0, 3, 256])
def test_hot_strings(spark, hot):
    rows = spread_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_seen(df, hot_blocks=hot).collect())
    # rows without id stand first, in some order
    wants = []
    for head in ([120, 121, 122], [121, 120, 122]):
        own = [rows[i] for i in head] + sorted(r for r in rows if r[0] is not None)
        found = bytes_kept(list(enumerate(x[1] for x in own)), 100)
        wants.append(sorted((str(own[i][0]), *v) for i, v in found.items()))
    assert got in wants


def test_seen_earlier_against_pairs():
    rng = np.random.default_rng(5)
    depth, slack = 3, 4
    for n in (1, 2, 40, 200):
        rows = rng.integers(0, 2, (n, depth + 2 * slack + 2), dtype=np.uint8)
        rows[:, -2:] = rng.integers(0, slack + 1, (n, 2))
        for r in rows:
            r[: slack - r[-2]] = 0
            r[slack + depth + r[-1] : -2] = 0
        got = suffixes.seen_earlier(rows, depth, slack)
        seen = set()
        for r, bits in zip(rows, got.tolist(), strict=True):
            own = []
            for shift in range(slack + 1):
                if r[-2] >= shift and r[-1] >= slack - shift:
                    own.append((shift, bytes(r[slack - shift : slack - shift + depth + slack])))
                    assert (bits >> shift & 1) == (own[-1] in seen)
                else:
                    assert not bits >> shift & 1
            seen.update(own)


def test_long_text(spark):
    """Some megabytes in one text, once as a run of one character, once as words with a part again."""
    rng = random.Random(1)
    words = " ".join(f"w{rng.randint(0, 10**5)}" for _ in range(300_000))
    rows = [(1, "a" * 3_000_000), (2, words + words[:5000]), (3, "short")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.remove_seen(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (3_000_000, 2_999_999, 1), 2: (len(words) + 5000, 5000, 1), 3: (5, 0, 0)}
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 2 * (len(words[:5000].split()) - 2), 3: 0}  # the first word is joined to the one before, the last one cut


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        v = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert (B.unpack(B.pack(v)) == v).all()
    prints = np.array([8, 8, 12, 16], dtype=np.uint64)
    assert B.flagged(prints, np.array([False, True, False, True])).tolist() == [8 | 3, 12, 16 | 2]
    assert B.flagged(np.zeros(0, dtype=np.uint64)).size == 0


def test_cover_meets_every_pair():
    marks = set(suffixes.COVER)
    for i in range(suffixes.PERIOD):
        for j in range(suffixes.PERIOD):
            assert any((i + s) % suffixes.PERIOD in marks and (j + s) % suffixes.PERIOD in marks for s in range(suffixes.PERIOD))
