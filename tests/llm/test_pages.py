import base64
import gzip
import hashlib
import io
import json
import math
import struct
import zipfile

import pytest

from poiloom.llm import html_text as H
from poiloom.llm import warc as A

ARTICLE = "<h1>Title &amp; more</h1><p>First  paragraph with\n<b>bold</b> words<br>and a <a href='/x'>link</a>.</p><p>Second &eacute;&#233; one<p>Third, unclosed"
WANT = "Title & more\n\nFirst paragraph with bold words and a link.\n\nSecond éé one\n\nThird, unclosed"


def test_article():
    page = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></ul></nav><!-- <p>no</p> --><div class='ad'>Buy now, a long advert text.</div><article>{ARTICLE}<aside>not this</aside><section id=comments><p>I disagree with all of this.</p></section><form><p>Send</p></form></article><footer>&copy; us</footer></body></html>"
    assert H.main_text(page) == WANT


def test_without_article():
    links = "".join(f"<li><a href='/{i}'>Some link text {i}</a></li>" for i in range(20))
    text = "".join(f"<p>{'A sentence of the text itself, number %d. ' % i * 4}</p>" for i in range(6))
    page = f"<html><body><div><ul>{links}</ul></div><div id=c><div class=body>{text}</div></div><div><a href=/>imprint</a></div></body></html>"
    got = H.main_text(page)
    assert got.count("\n\n") == 5 and "link" not in got and "imprint" not in got


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<<>>", "</div></p>", "plain & text", "<script>x", "<!--", "<div>" * 5000 + "deep" + "</div>" * 5000, "<p hidden>x</p><p>yes</p>", "<a><b></a></b>"])
def test_odd_pages(page):
    assert isinstance(H.main_text(page), str)


def test_odd_results():
    assert H.main_text("plain & text") == "plain & text"
    assert H.main_text("<div>" * 3000 + "deep") == "deep"
    assert H.main_text("<p hidden>x</p><p>yes</p>") == "yes"
    assert H.main_text("<article><p>a</p><span class='ad'>no</span><p>b</p></article>") == "a\n\nb"


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "content-sidebar-wrap", "with-ads", "nav-fixed", "widget-area", "post-share-enabled", "sidebar", "widget-container"])
def test_wrappers_stay(name):
    assert H.main_text(f"<body><div class='{name}'><article>{ARTICLE}</article></div></body>") == WANT
    text = "".join(f"<p>{'A sentence of the text itself, number %d. ' % i * 4}</p>" for i in range(6))
    assert H.main_text(f"<body><div id=x class='page {name}'><div>{text}</div></div></body>").count("sentence") == 24


def test_left_out_by_name_or_hidden():
    assert H.main_text("<article><p>a b c</p><div class='site-ads box'>no</div><div id=comments-list>no</div><div hidden=''>no</div><p>d e f</p></article>") == "a b c\n\nd e f"
    assert H.main_text("<article><section title='The hidden cost'><p>yes</p></section></article>") == "yes"
    assert H.main_text("<article><p>a</p></article><ol class=comments><li><article class=comment><p>no, not at all</p></article></ol>") == "a"
    assert H.main_text("<article><p>one <svg a='/>' width=3 /> two</p><math/><p>three</p><svg><text>no</text></svg></article>") == "one two\n\nthree"


def test_text_beside_the_core():
    text = "".join(f"<p>{'A sentence of the text itself, number %d. ' % i * 4}</p>" for i in range(6))
    page = f"<body><div>long bare introduction<h2>Head</h2><div class=body>{text}</div>long bare<br>end<ul><li><a href=/>a link</a></ul></div></body>"
    got = H.main_text(page).split("\n\n")
    assert got[:2] == ["long bare introduction", "Head"] and got[-1] == "long bare end" and len(got) == 9


def slow_core(root):
    """The densest element, each count made anew for each element."""

    def nodes(n):
        yield n
        for c in n.items:
            if isinstance(c, H.Node):
                yield from nodes(c)

    own = {id(n): (n.chars, n.tags, n.link_chars, n.link_tags) for n in nodes(root)}

    def counts(n):
        below = [own[id(x)] for x in nodes(n)]
        chars, tags, links, link_tags = (sum(x) for x in zip(*below, strict=True))
        return chars, tags + len(below) - 1, min(links, chars), link_tags

    body = counts(root)

    def density(n):
        chars, tags, links, link_tags = counts(n)
        if not chars:
            return 0.0
        base = 1 + math.log(chars / max(chars - max(links, 1), 1) * links + (body[2] / body[0]) * chars + math.e)
        return chars / max(tags, 1) * max(0.0, math.log(chars / max(links, 1) * max(tags, 1) / max(link_tags, 1) + 1, base))

    def total(n):
        children = [density(c) for c in n.items if isinstance(c, H.Node)]
        return sum(children) if children else density(n)

    every = list(nodes(root))
    sums = [total(n) for n in every]
    return every[sums.index(max(sums))]


def test_core_of_all_pages():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()
    links = "".join(f"<li><a href='/{i}'>Some link text {i}</a></li>" for i in range(20))
    pages += [f"<body><div><ul>{links}</ul></div><main><div><p>{'words of a text ' * 40}</p><p>more</p></div><ul>{links}</ul><p>short</p></main>{links}</body>", "x", "<p>a<p>b"]
    found = []
    for page in pages:
        want = slow_core(H.parse(page))  # parsing is deterministic: the same element is found by its way from the top
        order = H.weigh(H.parse(page))
        best = H.densest(order)

        def way(n):
            return () if n.parent is None else (*way(n.parent), [c for c in n.parent.items if isinstance(c, H.Node)].index(n))

        assert way(best) == way(want)
        found.append(best.tag)
    assert found.count("article") == len(pages) - 3  # the densest one, not the one of that name


def test_parts_of_articles():
    text = "".join(f"<p>{'A sentence of the text itself, number %d. ' % i * 4}</p>" for i in range(6))
    links = "".join(f"<li><a href='/{i}'>Some link text {i}</a></li>" for i in range(20))
    page = f"<body><article><header><div class=meta>by someone</div><h1>Title</h1><a href=/>share</a></header><p>Lead.</p><div class=text>{text}</div><ul>{links}</ul><p>End.</p></article></body>"
    got = H.main_text(page).split("\n\n")
    assert got[:2] == ["Title", "Lead."] and got[-1] == "End." and len(got) == 9
    assert H.main_text("<body><header><h1>Site</h1></header><p>a b c</p></body>") == "a b c"
    assert H.main_text("<p>a\u00a0&nbsp;b</p>") == "a b"


def test_extract(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>"), (2, None, None), (2, None, None), (None, "", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "0 as n_chars")
    got = H.extract_text(df).collect()
    assert sorted((r.page_id or 0, r["text"], r.n_chars) for r in got) == [(0, "x", 1), (1, WANT, len(WANT)), (2, "", 0), (2, "", 0)]
    assert H.extract_text(df.limit(0)).count() == 0


def test_round_trip(spark):
    rows = [(i, f"http://x/{i % 3}\n", ["<p>same</p>", None, f"<p>ü {i}</p>", "", "<p>same</p>" * 50][i % 5]) for i in range(40)] + [(None, None, "<p>same</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).selectExpr("*", "'r' as record_type")
    for least in (0, 5, 1000):
        got = {r.page_id: r for r in A.round_trip(df, least).collect()}
        assert len(got) == len(rows)
        for page_id, _, page in rows:
            raw = (page or "").encode()
            first = min(i for i, _, p in rows if i is not None and (p or "") == (page or "")) if len(raw) >= least else page_id
            r = got[page_id]
            assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
            assert (r.record_type, r.refers_to) == (("response", None) if first == page_id else ("revisit", first))
    assert A.round_trip(df.limit(0)).count() == 0


def test_repeated_page(spark):
    df = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in A.round_trip(df).collect()) == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]


def package(n: int) -> bytes:
    out = io.BytesIO()
    out.close_ = out.close
    out.close = lambda: None
    p = A.Package(out)
    for i in range(n):
        p.add(str(i), f"http://x/{i}", b"payload %d" % i, None if i % 2 == 0 else "0")
    p.close()
    return out.getvalue()


def test_range_reads():
    raw = package(300)
    reads = []

    def read(at, n):
        reads.append(n)
        return raw[at : at + n]

    got = list(A.read_package(read, len(raw)))
    assert sorted(int(r["page_id"]) for r in got) == list(range(300)) and got[0]["payload_bytes"] > 0
    assert max(reads[-300:]) < 600  # each record by its own range
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}


def zip64(raw: bytes) -> bytes:
    """The same package with a ZIP64 directory: 32-bit fields full, real values in the extra fields."""
    end = raw.rfind(A.END)
    count, length, start = struct.unpack_from("<HII", raw, end + 10)
    central, at, new = raw[start : start + length], 0, b""
    for _ in range(count):
        packed, full, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", central, at + 20)
        local = struct.unpack_from("<I", central, at + 42)[0]
        extra = struct.pack("<HHQQQ", 1, 24, full, packed, local)
        head = bytearray(central[at : at + 46])
        struct.pack_into("<II", head, 20, 0xFFFFFFFF, 0xFFFFFFFF)
        struct.pack_into("<H", head, 30, len(extra))
        struct.pack_into("<I", head, 42, 0xFFFFFFFF)
        new += bytes(head) + central[at + 46 : at + 46 + name_n] + extra
        at += 46 + name_n + extra_n + comment_n
    end64 = A.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, len(new), start)
    locator = A.LOCATOR64 + struct.pack("<IQI", 0, start + len(new), 1)
    comment = b"a comment with PK\x05\x06 in it"
    return raw[:start] + new + end64 + locator + A.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, len(comment)) + comment


def test_zip64():
    raw = package(20)
    wide = zip64(raw)
    read = lambda r: lambda at, n: r[at : at + n]
    assert A.directory(read(wide), len(wide)) == A.directory(read(raw), len(raw))
    assert len(list(A.read_package(read(wide), len(wide)))) == 20


@pytest.mark.parametrize("damage", [lambda r: r[:-30], lambda r: b"", lambda r: r[:100] + b"\x00" * 30 + r[130:]])
def test_damage_is_an_error(damage):
    raw = damage(package(5))
    with pytest.raises(Exception):
        list(A.read_package(lambda at, n: raw[at : at + n], len(raw)))


def test_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("a"), "stored")
        z.writestr("b", "packed" * 100, zipfile.ZIP_DEFLATED)
    raw = out.getvalue()
    assert {k: v[2] for k, v in A.directory(lambda at, n: raw[at : at + n], len(raw)).items()} == {"a": False, "b": True}


def test_rows_of_equal_ids(spark):
    # an id that occurs with several payloads, null ids, odd urls: what is written is told by id and payload together
    html = ["x", "y", None, "", "unique", "x" * 3000]
    rows = [(i % 3 if i % 4 else None, ["a 20240101000000 b", 'q"uote {1}', "\r\n", None][i % 4], html[i % 6]) for i in range(60)] + [(6, "u", "a"), (1, "u", "a"), (6, "u", "only here"), (7, "u", "by null"), (None, "u", "by null")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = []
    for page_id, _, page in rows:
        raw = (page or "").encode()
        first = min((i for i, _, p in rows if i is not None and (p or "") == (page or "")), default=None)
        again = first is not None and page_id != first
        want.append((str(page_id), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", str(first) if again else "None"))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in A.round_trip(df).collect()]
    assert sorted(got) == sorted(want)


def test_names_as_ids(spark):
    rows = [("b:1 >", "u", "x"), ("a/ä", "u", "x"), ("", "u", "z")]
    got = A.round_trip(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert sorted((r.page_id or "", r.record_type, r.refers_to) for r in got) == [("", "response", None), ("a/ä", "response", None), ("b:1 >", "revisit", "a/ä")]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_package_of_another_writer(method):
    """Other member names, time stamps, a gzipped index, numbers as strings, no digests."""
    bodies = {f"http://x/{i}": b"body %d " % i * (i * 400) for i in range(12)}
    data, lines = b"", ["!meta 0 {}"]
    for i, (url, body) in enumerate(bodies.items()):
        http = b"HTTP/1.1 200 OK\r\nServer:  x\r\n\r\n" + body
        head = f"WARC/1.0\r\nWARC-Type:response\r\nWARC-Record-ID: <urn:uuid:{i}>\r\nWARC-Target-URI: {url}\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n".encode()
        packed = gzip.compress(head + http + b"\r\n\r\n")
        lines.append(f'x,{i} )/ {["2020", "20210304", "20240101000000", "20240101000000123"][i % 4]} ' + json.dumps({"url": url, "filename": "crawl-1.warc.gz", "offset": str(len(data)), "length": str(len(packed))}))
        data += packed
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        z.writestr("datapackage.json", "{}")
        z.writestr("archive/crawl-1.warc.gz", data)
        z.writestr("indexes/index.cdx.gz", gzip.compress("\n".join(lines).encode()))
    raw = out.getvalue()
    got = {r["url"]: r for r in A.read_package(lambda at, n: raw[at : at + n], len(raw))}
    assert {u: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["page_id"][:9]) for u, r in got.items()} == {u: (len(b), A.digest(b), "response", "<urn:uuid") for u, b in bodies.items()}


def test_hot_keys_join(spark, monkeypatch):
    from poiloom.llm import common

    rows = [(None if i % 3 == 0 else i % 7, i) for i in range(500)]
    left = spark.createDataFrame(rows, "k long, v long")
    sums: dict = {}
    for k, _ in rows:
        sums[k] = sums.get(k, 0) + 1
    right = spark.createDataFrame([(k, n, f"of {k}") for k, n in sums.items() if k != 2], "k long, n long, name string")
    right = common.stored(right, "test")
    for side, total in ((0, 0), (0, 500), (0, 500 * common.HOT), (0, 100 * common.HOT), (1 << 20, 500)):
        monkeypatch.setattr(common, "SIDE_BYTES", side)
        got = common.spread_join(left, right, ["k"], "n", total).collect()
        assert sorted((str(r.k), r.v, str(r["name"])) for r in got) == sorted((str(k), v, "None" if k == 2 else f"of {k}") for k, v in rows)
