"""Page operators: archives and main text."""

import gzip
import hashlib
import io

import pytest

from marketlens.functions.settle import fresh_path
from marketlens.llm import html_text, warc

LONG = "<p>" + "long enough to be worth a reference " * 5 + "</p>"
EXTRA = "payload string, digest string, host string, id string, stamp string, content string, deleted string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(5, "http://a.com/x", LONG), (2, "http://b.com/y y\r\nWARC-Type: x", LONG), (9, None, LONG), (1, "http://a.com/s", "short"), (3, "http://a.com/s", "short"),
            (4, "", None), (6, "http://a.com/é", ""), (None, "http://a.com", LONG), (7, "http://a.com", "é" * 60), (8, "http://a.com", "é" * 60), (2, "http://b.com", LONG),
            (10, "http://a.com/long", "<p>" + "word " * 100_000 + "\r\n\r\n</p>")]
    return spark.createDataFrame([(*r, *[None] * 7) for r in rows], f"page_id long, url string, html string, {EXTRA}").repartition(3)


def test_round_trip(spark, pages):
    rows = [(r["page_id"], r["html"] or "") for r in pages.collect()]
    got = warc.round_trip(spark, pages).collect()
    assert len(got) == len(rows)
    payloads = {(p, hashlib.sha256(h.encode()).hexdigest()): len(h.encode()) for p, h in rows}
    for r in got:
        size = payloads[r["page_id"], r["payload_digest"]]
        same = [p for (p, d) in payloads if d == r["payload_digest"] and p is not None]
        first = min(same)
        revisit = size >= warc.REVISIT_BYTES and r["page_id"] != first
        assert (r["payload_bytes"], r["record_type"], r["refers_to"]) == (size, "revisit" if revisit else "response", first if revisit else None), r
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_files_are_archives(spark, pages):
    manifest = warc.write_archives(pages, fresh_path(spark, "warc-test"), archive_bytes=1000).collect()
    assert sum(r["records"] for r in manifest) == pages.count() and len(manifest) >= 3
    path = manifest[0]["file"].removeprefix("file:")
    data = open(path, "rb").read()
    plain = gzip.decompress(data)
    assert plain.startswith(b"WARC/1.1\r\n") and plain.count(b"WARC/1.1\r\n") == manifest[0]["records"] == data.count(b"\x1f\x8b\x08")


def test_reader_faults():
    good = warc.record(1, "http://a", b"payload" * 50, hashlib.sha256(b"payload" * 50).hexdigest(), None)
    read = lambda data, n: [warc.page_row(*x) for x in warc.ArchiveReader(io.BytesIO(data), n)]
    assert read(good + good, 7) == read(good + good, 1 << 18) and len(read(good * 3, 64)) == 3
    assert read(b"", 10) == []
    with pytest.raises(EOFError):
        read(good[:-12], 64)
    bad = warc.record(1, "http://a", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError):
        read(bad, 64)
    other = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert read(gzip.compress(other) + good, 64)[0] is None


ARTICLE = "<article><header><h1>A &amp; B</h1></header><p>One<br>two <b>three<p>four&nbsp;five &lt;x&gt; &#233; &quo</article>"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("  \n ", ""), ("plain text", "plain text"),
    (f"<html><body><nav><ul><li>menu<li>more</ul></nav>{ARTICLE}<footer>foot</footer>", "A & B\nOne two three\nfour five <x> é &quo"),
    ("<header>site</header><main><p>a</p><div class='ad box'>buy</div><div id=comments><p>c</p></div></main><aside>side</aside>", "a"),
    ("<p>a<script>var t='</p><p>x';</script>b</p><style>p{}</style><!-- <p>no</p> --><p>c", "ab\nc"),
    ("<div class=cookie-notice>we use</div><table><tr><td>1<td>2<tr><td>3</table><form>f<input></form>", "1\n2\n3"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"), ("<p>x < y and y > z</p>", "x < y and y > z"),
    ("<div hidden>h</div><p style='display:none'>n</p><p>ok</p><p title='a>b'>q", "ok\nq"), ("<article>cut off in the mid", "cut off in the mid"),
    ('<div class="layout with-sidebar"><article><p>t</p></article></div>', "t"), ('<article class="post has-sidebar"><p>t</p></article>', "t"),
    ('<div id="page" class="no-comments social"><article><p>t</p></article></div>', "t"),
    ('<article><section class="social-science"><p>t</p></section><p class="notice-period">u</p><div class="share-buttons">s</div><ul class=site-nav><li>n</ul></article>', "t\nu"),
    ("<article><p>in</p><article class=comment><p>reader</p></article></article>", "in"), ("</p></div>stray", "stray"),
])
def test_extract(html, text):
    assert html_text.extract(html) == text


def test_long_nesting():
    assert html_text.extract("<div>" * 5000 + "deep") == "deep"
    assert html_text.subtrees("<div>" * 5000 + "deep")[1] != 0


def test_templates_go_and_copies_stay(spark, pages):
    box = "<div><span>Read our great stories</span></div>"
    rows = [(i, "http://site.com/%d" % i, f"<body>{box}<p>{'text %d ' % i * 20}</p></body>") for i in range(8)]
    rows += [(20 + i, "http://other.com/%d" % i, f"<body><div>Only here {'again ' * 30}</div></body>") for i in range(9)]
    rows += [(40 + i, "http://rare.com/%d" % i, f"<body>{box}<p>{'text %d ' % i * 20}</p></body>") for i in range(2)]
    rows += [(60 + i, "HTTP://Site.com/a", f"<body><article><p>shared words stay</p><p>{'copy %d ' % i * 20}</p></article></body>") for i in range(7)]
    got = {r["page_id"]: r for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i]["text"] == " ".join(["text", str(i)] * 20) and got[i]["n_chars"] == len(got[i]["text"])
    assert got[20]["text"].startswith("Only here") and got[40]["text"].startswith("Read our great stories\ntext 0")
    assert got[63]["text"].startswith("shared words stay\ncopy 3")
    out = html_text.main_texts(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == pages.count() and html_text.main_texts(pages.limit(0)).count() == 0


def test_repeats_inside_articles_and_on_hot_hosts_stay(spark):
    own = lambda i: f"<p>{'text %d ' % i * 20}</p>"
    table, quote, box, notice = "<ul><li>same part list</ul>", "<div><p>a quote that some repeat</p></div>", "<div><b>Read on</b></div>", f"<div class=cookie>{'We use cookies. ' * 40}</div>"
    rows = [(i, f"http://one.com/{i}", f"<article>{own(i)}{table}<section><div>wrapped words</div></section></article>") for i in range(9)]
    rows += [(100 + i, f"http://hot.com/{i}", f"<body>{box}{own(i)}{quote if i < 6 else ''}</body>") for i in range(200)]
    rows += [(400 + i, f"http://notice.com/{i}", f"<body>{notice}{box}{own(i)}</body>") for i in range(8)]
    got = {r["page_id"]: r["text"] for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = lambda i: " ".join(["text", str(i)] * 20)
    assert all(got[i] == f"{text(i)}\nsame part list\nwrapped words" for i in range(9))
    assert all(got[100 + i] == text(i) + ("\na quote that some repeat" if i < 6 else "") for i in range(200))
    assert all(got[400 + i] == text(i) for i in range(8))


def test_query_on_whole_table(spark, sf_dir):
    from marketlens.llm.queries import QUERIES

    raw = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op10_template_html_text"](spark, sf_dir).collect()
    assert len(got) == len(raw)
    for r in got:
        assert r["n_chars"] == len(r["text"]) and "track(" not in r["text"] and "middot" not in r["text"] and "<p>" not in r["text"]
