import base64
import hashlib
import math
import random
import re

import numpy as np
import pytest

from poiloom.llm import secrets as S

PATTERNS = [
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def base(text):
    found = [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, (kind, p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m)]
    return [x[2] for x in sorted(found)]


def test_base_spans(spark):
    rng = random.Random(4)
    parts = ["password", "Token", "api_key", "APIKEY=", "secret='", ": ", " = ", '"', "abc123", "AKIA" + "A1" * 9, "AKIA12", "0f" * 13, "deadbeef", "é🙂", " ", "\n", "token=secret=abcdefgh", "ſecret=abcdefgh", "passwd:"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in S.find_secrets(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = base(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [x for x in got[i].spans.split(",") if x and not x.startswith("random")] == want
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex"))


def test_random_strings_are_found(spark, rows):
    rng = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    planted = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(15)] + [base64.b64encode(rng.randbytes(48)).decode() for _ in range(15)]
    plain = ["averyveryverylongwordindeedthatgoeson", "https-path/with/many/parts/and-words", "_" * 40, "ab" * 30, "1234567890" * 3, "internationalisation-of-everything"]
    ordinary = [r[1] for r in rows if r[1]]
    texts = [f"{o[:300]} {x} {o[300:500]}" for o, x in zip(ordinary * 2, planted + plain, strict=False)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in S.find_secrets(df).collect()}
    hits = [i for i, t in enumerate(texts) if any(s.startswith("random") for s in got[i].split(","))]
    assert sum(i < len(planted) for i in hits) >= 0.9 * len(planted)
    assert all(i < len(planted) for i in hits)
    kind, start, end = next(s for s in got[hits[0]].split(",") if s.startswith("random")).split(":")
    assert texts[hits[0]][int(start) : int(end)] == planted[hits[0]]


@pytest.mark.parametrize("length", [20, 32, 64])
def test_every_encoding(spark, length):
    """Of random strings in each encoding 9 of 10 are found among texts with long words, numbers, names and paths, of which none is."""
    rng = random.Random(length)
    texts_ = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text and len(r.text) > 600 and not re.search("[0-9]", r.text)]
    some = lambda n: rng.choice(texts_)[:n]
    plain = ["Donaudampfschifffahrtsgesellschaft", "usr/local/share/documents/readme", "get_user_name_from_session", "12345678901234567890", "2024-01-01-some-title-of-a-page", "zzzzzzzzzzzzzzzzzzzzzzzzzz", "GeneralInformationPageOfTheLibrary", "internationalization-guide"]
    texts, encodings = [], []
    for k, alphabet in enumerate(S.ALPHABETS):
        for _ in range(40):
            token = "".join(rng.choice(alphabet) for _ in range(length))
            texts.append(f"{some(3000)} {token} {some(100)}")
            encodings.append(k)
    texts += [f"{some(3000)} {x} {some(100)}" for x in plain * 10]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hit = {r.doc_id: r.spans for r in S.find_secrets(df).collect()}
    # base 16 in lower case from 24 characters on is a fixed pattern
    for k in range(len(S.ALPHABETS)):
        assert sum(bool(hit[i]) for i, e in enumerate(encodings) if e == k) >= 36, S.ALPHABETS[k]
    assert [x for i, x in enumerate(plain) if hit[len(encodings) + i]] == []


def test_battery_of_random_strings():
    # all three tests together reject hardly any random string, and text nearly always
    rng = np.random.default_rng(2)
    for alphabet in S.ALPHABETS:
        own = np.frombuffer(alphabet.encode(), dtype=np.uint8)
        for n in (20, 40, 200):
            p = S.battery(own[rng.integers(0, len(own), (2000, n))])
            assert (p < S.BATTERY).mean() < 0.03
    text = np.frombuffer(b"itwasabrightcolddayinaprilandtheclockswerestrikingthirteen" * 4, dtype=np.uint8)[None, :]
    assert S.battery(text)[0] < 1e-6 and S.battery(np.frombuffer(("é" * 10).encode(), dtype=np.uint8)[None, :])[0] == 0
    # each row for itself
    rows = np.stack([own[rng.integers(0, len(own), 30)] for own in (np.frombuffer(a.encode(), dtype=np.uint8) for a in S.ALPHABETS)])
    assert np.allclose(S.battery(rows), [S.battery(r[None, :])[0] for r in rows])


def test_keys_behind_names_and_paths(spark, rows):
    rng = random.Random(6)
    key = lambda more="": "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + more) for _ in range(40))
    heads = ["AWS_SECRET_ACCESS_KEY=", "GITHUB_PAT=ghp_", "AccountKey=", "https://x.org/?sig=", "auth=", "a_b/", "some-dir/some_name/"]
    ordinary = [r[1] for r in rows if r[1]]
    texts, keys = [], []
    for i in range(42):
        own = key("+/") if i % 7 == 0 else key()
        own += "==" if i % 7 == 2 else ""
        keys.append(own)
        texts.append(f"{ordinary[i % 20][:200]} {heads[i % 7]}{own} {ordinary[i % 20][200:300]}")
    plain = ["LD_LIBRARY_PATH=/usr/local/share/some-long-name_of/the-directory", "class=averylongnameofaclass-with_parts/inner", "a=b=c=d=e=f=g=h=i=j=k=l=m=n=o=p"]
    df = spark.createDataFrame(list(enumerate(texts + plain)), "doc_id long, text string")
    got = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("random")] for r in S.find_secrets(df).collect()}
    for i, (text, own) in enumerate(zip(texts, keys, strict=True)):
        at = text.index(own)
        inside = [(a, b) for a, b in got[i] if a <= at and b >= at + len(own)]
        assert len(got[i]) <= 1 and all(a >= text.rfind("=", 0, at) + 1 for a, _ in got[i]), (i, got[i])
        keys[i] = bool(inside)
    for k in range(7):
        assert sum(keys[k::7]) >= 5, (heads[k], keys[k::7])
    assert not any(got[i] for i in range(len(texts), len(texts + plain)))
    clean = {r.doc_id: r.text for r in S.redacted_documents(df).collect()}
    assert sum("[SECRET]" in t for t in clean.values()) == sum(map(bool, got.values()))


def test_parts():
    assert S.parts("A" * 20 + "==" + "b" * 19 + "=") == [(0, 20), (22, 42)]
    assert S.parts("a_b/" + "K" * 20 + "==") == [(2, 26), (4, 26)]


def test_binomial_tail():
    for hits, trials, p in ((3, 10, 0.1), (10, 10, 0.2), (0, 5, 0.5), (40, 300, 0.02), (1, 4, 0.5), (0, 0, 0.1)):
        want = sum(math.comb(trials, k) * p**k * (1 - p) ** (trials - k) for k in range(hits, trials + 1))
        assert S.binomial_tail(hits, trials, p) == (pytest.approx(math.log(want)) if hits > trials * p else 0)


def test_step_up():
    assert S.step_up([(0, 100, 5), (0, 10, 1), (0, 0, 94)]) == {0: 10.0}
    assert S.step_up([(0, 0, 10)]) == {}


def test_redaction(spark, docs, empty):
    df = docs.limit(3).unionByName(spark.createDataFrame([(1001, "a token = 0123456789abcdef0123456789abcdef b", "en", "a", 44)], "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    got = S.redacted_documents(df)
    assert got.columns == df.columns and got.count() == 4
    r = got.where("doc_id = 1001").first()
    assert r.text == "a [SECRET] b" and r.n_chars == len(r.text)
    assert S.redacted_documents(empty).count() == 0 and S.find_secrets(empty).count() == 0
    assert S.redact("abcdefgh", [(0, 1, 3), (2, 2, 5), (0, 6, 7)], "#") == "a#f#h"
