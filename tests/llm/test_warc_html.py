"""Operators 9 and 10: exact round trips and hand-made pages."""

import hashlib
import html
import io
import random
import re
import zlib
from collections import Counter

import pytest

from hourglass.llm import html_extract, queries, warc

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) by plain Python."""
    first = {}
    for i, _, h in rows:
        if i is not None:
            p = (h or "").encode()
            first[p] = min(i, first.get(p, i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        to = first.get(p) if len(p) >= 100 and first.get(p) != i else None
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if to is None else "revisit", to))
    return Counter(out)


def test_warc_query_round_trip(spark, pages):
    got = Counter(map(tuple, queries.op9_warc(spark, SF).collect()))
    assert got == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_warc_copies_odd_rows_and_rolling(spark):
    body = "é" * 60 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(5, "http://a/\r\nb ü", body), (3, None, body), (9, "u", body), (None, "n", body), (3, "again", body), (4, "u", "short"),
            (6, "u", "short"), (7, "u", None), (8, "u", ""), (None, None, "y" * 200), (None, "v", "y" * 200)]
    rows += [(100 + i, "u", "z" * 100) for i in range(50)]
    given = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    back = warc.archive_round_trip(given, archive_bytes=500).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, back.collect())) == expected(rows)
    assert warc.archive_round_trip(given.limit(0)).count() == 0


def test_members_and_index(spark, tmp_path):
    mono = warc.Monolith(f"{tmp_path}/m.warc.gz")
    given = [(str(i), f"http://x/{i}", random.Random(i).randbytes(i * 997), None if i % 3 else "0") for i in range(30)]
    for i, u, p, to in given:
        mono.add(warc.record(i, u, p, hashlib.sha256(p).hexdigest(), to))
    mono.close()
    raw = (tmp_path / "m.warc.gz").read_bytes()
    whole = zlib.decompressobj(31)
    whole.decompress(raw)
    assert whole.eof and not whole.unused_data  # one member
    assert warc.normalise_file(f"{tmp_path}/m.warc.gz", f"{tmp_path}/n.warc.gz") == 30
    index = list(warc.read_index(f"{tmp_path}/n.warc.gz"))
    with open(tmp_path / "n.warc.gz", "rb") as f:
        for e, (i, _, p, to) in reversed(list(zip(index, given, strict=True))):
            fields, payload = warc.read_member(f, e["offset"], e["length"])
            assert fields["Page-Id"] == i and payload == (p if to is None else b"") and e["id"] == fields["WARC-Record-ID"]
    # normalising a normalised archive changes nothing
    warc.normalise_file(f"{tmp_path}/n.warc.gz", f"{tmp_path}/again.warc.gz")
    assert (tmp_path / "again.warc.gz").read_bytes() == (tmp_path / "n.warc.gz").read_bytes()
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(warc.inflated(io.BytesIO(raw[:-4000]))))


def test_html_query_equals_article(spark, pages):
    rows = {r.page_id: r for r in queries.op10_html_text(spark, SF).collect()}
    every = pages.collect()
    assert len(rows) == len(every)
    for r in every:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(b for b in blocks if b)
        assert rows[r.page_id].text == want and rows[r.page_id].n_chars == len(want) and rows[r.page_id].url == r.url


P1 = "First paragraph, with a comma, and enough words to count as text of the article itself."
P2 = "Second paragraph &amp; more text, of which there is plenty, so that the container scores well."
JUNK = ('<nav><ul><li><a href="/a">Home</a></ul></nav>', '<div class="cookie-notice">We use cookies, as everybody does, to count you.</div>',
        '<div id="sidebar"><p>Popular, new, and interesting things that are not of this article at all.</p></div>',
        '<form><p>Sign up, please, for our letter, with your name and address here.</p></form>', '<script>var x="<p>not, text</p>";</script>',
        '<section class="comments"><article><p>Great article, I liked it, and will read it again, for sure.</p></article></section>',
        '<footer><p>Copyright, all rights reserved, and a long line of legal words follows here.</p></footer>',
        '<style>p{color:red}</style>', '<ul><li><a href=1>One more story</a><li><a href=2>And another</a></ul>',
        '<div style="display: none">hidden, words, that nobody, sees on this page at all</div>', '<div hidden><p>hidden too, long enough to count as a paragraph</p></div>',
        '<!-- <p>comment</p> -->', '<header><p>Site name, motto of the site, and a very long line of words.</p></header>')


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div><section>{}</section></div>", "{}"])
def test_junk_is_left_out(wrap):
    body = f"<h1>The  title</h1>\n<p>{P1}<p>{P2} <b>bold</b>"
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(JUNK)}{wrap.format(body)}{''.join(JUNK)}"
    want = f"The title\n{P1}\n{html.unescape(P2)} bold"
    assert html_extract.main_text(page) == want
    inside = f"<html><body>{wrap.format(body + ''.join(j for j in JUNK if '<header' not in j))}</body></html>"
    assert html_extract.main_text(inside) == want


def test_html_odd_rows(spark):
    page = "<p>" + "word, " * 20 + "</p>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain < text & 5 > 4"), (3, "u", page), (3, "u", page), (4, "u", "<" * 50 + "a"),
            (5, "u", "<div>" * 3000 + "deep, deep, deep down in the page there is text" + "</div>" * 3000),
            (6, "u", "<p>" + "x, y " * 200_000), (7, "u", "<script>never closed <p>text"), (8, "u", "<p>a&nbsp;&lt;b&gt;\t\n c<br>d<br><br>e</p>")]
    given = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.extract_main_text(given).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and by[1] == by[2] == by[7] == "" and by[None] == "plain < text & 5 > 4"
    assert by[3] == ("word, " * 20).strip() and by[5].startswith("deep") and len(by[6]) == 999_999 and by[8] == "a <b> c d\ne"
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract_main_text(given.limit(0)).count() == 0
