import base64
import glob
import gzip
import hashlib
import os
import random
import re

import numpy as np
import pytest

from moodlens.llm import html_text as H
from moodlens.llm import warc


def _lines(html):
    lines = H.text_lines(html)
    top = max((s for _, s in lines), default=-1)
    return [t for t, s in lines if s == top >= 0]


def test_markup():
    page = (
        '<!DOCTYPE html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav>m</nav>'
        '<article class="post"><header><h1>T &amp; U</h1><p>by x</p></header><p>a<b>b</b>\n c<br>d<p>e<div class="share">s</div><aside>z</aside>f'
        '<ul><li>1<li>2</ul><form>q</form><script>if (a < b) { "</p>" }</script><section id="comments"><p>bad</p></section></article>'
        '<div class="cookie-notice">ok?</div><footer>&copy; x</footer>'
    )
    assert _lines(page) == ["T & U", "ab c d", "e", "f", "1", "2"]
    assert _lines('<p>x <script>if(a<b){"</p>"}</script>y</p><!-- <p>c</p> --> <img alt="a>b"> t') == ["x y", "t"]
    assert _lines("a < b &lt; c &#8217; &eacute;&nbsp; d") == ["a < b < c ’ é d"]
    assert _lines('x<p class="notice">n</p>y<p hidden>h</p>') == ["x", "y"]
    assert _lines("<main><p>in</p></main><p>out</p>") == ["in"]
    assert _lines("<article><p><b>T<br><p>one") == ["T", "one"]
    assert _lines('<article><div class="post-header"><h2>T</h2></div><p>x</p><div class="alert">a</div></article>') == ["T", "x"]
    assert _lines("") == _lines(None) == []


def test_slugs_and_formulas_in_articles():
    page = (
        '<article><h2 id="related-work">R</h2><h3 id="comments">C</h3><section id="social-impact">S</section><div id="comment-faire">F</div><p id="notice">N</p>'
        '<p>x <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation encoding="application/x-tex">a+b</annotation></math> y</p>'
        '<div class="share-buttons">b</div><ul class="wide related-posts"><li>p</ul><div id="ad-slot-3">ad</div><p class="comment">c</p></article>'
    )
    assert _lines(page) == ["R", "C", "S", "F", "N", "x a+b y"]
    assert _lines('<div id="social-impact">s</div><p>t') == ["t"]


def test_shared_lines_are_a_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(50):
        a, b = (np.array(rnd.sample(range(12), rnd.randint(0, 12)), np.uint64) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        pairs = H.shared_lines(a, b)
        assert len(pairs) == best[-1, -1] and all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)
        assert sorted(j for _, j in pairs) == [j for _, j in pairs]


def _page(i, url, body):
    return (i, url, f"<html><body>{body}</body></html>")


def test_differencing(spark):
    nav = "<div>Home</div><div>About us</div>"
    rows = [_page(i, f"http://h/a/{i}", f"{nav}<div>own words of page {i} {'x' * i}</div><div>end</div>") for i in range(30)]
    rows += [_page(40, "http://copy/1", nav), _page(41, "http://copy/2", nav), _page(42, "http://k/", f"{nav}<article>a</article>"), _page(43, "http://k/b", "<article>a</article>"), (44, None, None), (45, "x", ""), (None, "y", "<p>z")]
    df = spark.createDataFrame(rows + rows[:2], "page_id long, url string, html string").selectExpr("*", "'c' AS host", "'c' AS gone", "'c' AS names")
    for parts in (1, 7):
        got = H.main_text(df.repartition(parts)).collect()
        assert len(got) == len(rows) + 2
        text = {r.page_id: r.text for r in got}
        assert all(text[i] == f"own words of page {i} {'x' * i}".strip() for i in range(30))
        assert text[40] == text[41] == "Home\nAbout us"  # copies say nothing about their site
        assert (text[42], text[43], text[44], text[45], text[None]) == ("a", "a", "", "", "z")
        assert all(r.n_chars == len(r.text) for r in got)
    assert H.main_text(df.limit(0)).count() == 0


def test_copies_and_short_pages(spark):
    nav = "".join(f"<div>menu entry {i}</div>" for i in range(12))
    long = [f"<div>{w} page with words of its own {w * 200}</div>" for w in ("first", "last")]
    copy = f"{nav}<div>the copied text {'c' * 200}</div>"
    rows = [_page(0, "http://h/a", nav + long[0]), *(_page(i, f"http://h/b?{i}", copy) for i in range(1, 6)), _page(6, "http://h/c", nav + long[1])]
    rows += [_page(10 + i, f"http://n/b{i}", f"{copy}<div>no {i}</div>") for i in range(1, 6)]  # near copies
    rows += [_page(10, "http://n/a", nav + long[0]), _page(16, "http://n/c", nav + long[1])]
    rows += [_page(20, "http://s/a", nav + long[0]), _page(21, "http://s/b", f"{nav}<div>short</div>"), _page(22, "http://s/c", nav + long[1])]
    rows += [_page(30, "http://i/a", f"{nav}{copy[len(nav):]}{long[0] * 3}"), _page(31, "http://i/b", copy), _page(32, "http://i/c", nav + long[1])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    for coalesce in (kept, "false"):  # false: the runs lie in several partitions
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        try:
            text = {r.page_id: r.text for r in H.main_text(df).collect()}
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
        own = f"the copied text {'c' * 200}"
        assert all(text[i] == own for i in range(1, 6))
        assert all(text[10 + i] == f"{own}\nno {i}" for i in range(1, 6))
        assert all("menu" not in text[i] and "own" in text[i] for i in (0, 6, 10, 16, 20, 22))
        assert text[21] == "short"
        assert text[31] == own  # an index that repeats the page does not delete it


def test_copies_of_articles_are_passed_over(spark):
    """pages with articles are aligned too, so that a copy of several of them meets the page before them."""
    nav = "".join(f"<div>menu entry {i}</div>" for i in range(12))
    own = f"the copied text {'c' * 900}"
    rows = [_page(0, "http://h/a", f"{nav}<div>first page {'f' * 900}</div>"), _page(9, "http://h/d", f"{nav}<div>{own}</div>")]
    rows += [_page(i, f"http://h/b{i}", f"{nav}<article><p>{own}</p></article><div>no {i}</div>") for i in range(1, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 5):
        assert {r.page_id: r.text for r in H.main_text(df.repartition(parts)).collect()} == {0: f"first page {'f' * 900}", **{i: own for i in (1, 2, 3, 4, 9)}}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whole_table(spark, sf):
    import html as entities

    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in H.main_text(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>|<br>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in blocks if x)


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "u", "a\r\n\r\nb"), (3, "v", "a\r\n\r\nb"), (2, "v\nw", "é" * 9), (None, None, None), (5, "x", ""), (5, "x", ""), (7, "y", "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS sha", "'c' AS row", "'c' AS digest")
    path = str(tmp_path / "a")
    warc.write_archive(pages, path)
    got = warc.read_archive(spark, path).collect()
    assert sorted((r.page_id or 99, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [
        (1, 6, "response", None), (2, 18, "response", None), (3, 6, "revisit", 1), (5, 0, "response", None), (5, 0, "revisit", 5), (7, 100_000, "response", None), (99, 0, "revisit", 5),
    ]
    for r in got:
        payload = bytes(r.payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode() and len(payload) == r.payload_bytes
        assert f"\r\nContent-Length: {len(payload)}\r\n\r\n" in r.header and f"sha1:{r.payload_digest}\r\n" in r.header
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    warc.export_warc(warc.read_archive(spark, path), str(tmp_path / "w"))
    files = b"".join(gzip.open(f).read() for f in glob.glob(os.path.join(tmp_path, "w", "*.gz")))
    found, at = 0, 0
    while at < len(files):
        head = files[at : files.index(b"\r\n\r\n", at) + 4]
        assert head.startswith(b"WARC/1.1\r\n")
        at += len(head) + int(re.search(rb"Content-Length: (\d+)", head).group(1))
        assert files[at : at + 4] == b"\r\n\r\n"
        at, found = at + 4, found + 1
    assert found == len(rows)
    # The files read back give the archive's records, types and digests.
    again = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert sorted((r.header, bytes(r.payload), r.payload_bytes, r.payload_digest, r.record_type) for r in again) == sorted((r.header, bytes(r.payload), r.payload_bytes, r.payload_digest, r.record_type) for r in got)
    assert sorted(r.refers_to.split(":")[2] for r in again if r.refers_to) == ["1", "5", "5"]
    plain = tmp_path / "plain.warc"
    plain.write_bytes(files)
    assert warc.read_warc(spark, str(plain)).count() == len(rows)


def test_warc_fields_come_from_the_header(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "a")
    warc.write_archive(spark.createDataFrame([(-4, "u", "x"), (7, "v", "x"), (None, "w", "y")], "page_id long, url string, html string"), path)
    headers = spark.read.parquet(f"{path}/headers")
    assert headers.columns == ["sha", "header"]
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.read_archive(spark, path).collect()) == [(-4, "response", None), (0, "response", None), (7, "revisit", -4)]
    changed = headers.withColumn("header", F.replace("header", F.lit("Refers-To: <urn:page:-4:"), F.lit("Refers-To: <urn:page:9:")))
    changed.write.parquet(str(tmp_path / "b" / "headers"))
    spark.read.parquet(f"{path}/payloads").write.parquet(str(tmp_path / "b" / "payloads"))
    assert {r.refers_to for r in warc.read_archive(spark, str(tmp_path / "b")).collect()} == {None, 9}


@pytest.mark.parametrize("content", [b"HTTP/1.1 200\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", b"WARC/1.1\r\nContent-Length: 9\r\n"])
def test_damaged_warc_files_are_errors(content):
    with pytest.raises(ValueError):
        list(warc._records(content))


def test_warc_smaller_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.archive_round_trip(pages, min_bytes=4).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
