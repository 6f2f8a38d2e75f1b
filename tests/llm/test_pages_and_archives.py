"""Page extraction and WARC archives."""

import base64
import hashlib
import html as entities
import itertools
import os
import random
import re

import pytest

from ridepulse.llm import pages, queries, warc

PAGES = "page_id long, url string, html string, key string, at int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        got = sorted(pages.aligned(a, b))
        assert len(got) == brute_lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in got)


def test_blocks_drop_the_frame():
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header>Site</header><nav><a href=x>Menu</a></nav><div class="cookie-notice">We use cookies</div>
    <main><article><header><h1>Head &amp; line</h1></header><p>One   two<br>three <b>f</b>our.<p>Next<!-- no -->
    <div class=share>Share</div><script>var a="<p>no</p>";</script><p hidden>secret</p><p>Last&nbsp;one &eacute;</p>
    <section id="comments"><div><p>nice</p></div></section></article></main>
    <aside>Side</aside><form><input><p>Mail</p></form><div role="contentinfo">c</div><footer>f</footer></body></html>"""
    assert pages.main_text(pages.blocks(source), []) == "Head & line One two three four. Next Last one é"
    assert pages.blocks("") == [] and pages.blocks("plain <b>text") == [("plain text", False, False)]
    assert pages.main_text(pages.blocks("<p>a<p class=ad>b<p>c"), []) == "a c"


def test_names_drop_only_the_frame():
    text = lambda source: pages.main_text(pages.blocks(source), [])
    for kept in ('<article class="post comments-open"><p>a</p></article>', '<article class="no-sidebar">a</article>',
                 '<div class="content with-sidebar"><p>a</p></div>', '<section class="related-work">a</section>',
                 '<p>a</p><div class="with-sidebar"></div>', '<article><span class="search-term">a</span></article>',
                 '<div class="notice"><p>a</p></div>', '<article class="related">a</article>'):
        assert text(kept) == "a", kept
    for gone in ("ad", "ad-box", "cookie-notice", "main-nav", "post-comments", "related-posts", "share_buttons", "nav-2"):
        assert text(f'<article><p>a</p><div class="{gone}">b</div></article>') == "a", gone
    assert text('<article><p>a</p></article><article class="comment">b</article>') == "a"


def test_differencing_without_marks(spark):
    frame_top, frame_end = "<div>Daily News of Town</div>", "<div>All rights with us</div>"
    rows = [(i, f"http://h.example/{'abc'[i % 3]}/{i}", f"{frame_top}<p>Story {i} tells of number {i} and "
             f"its long way home through the town</p>{frame_end}") for i in range(30)]
    rows += [(90, "http://other.example/a", f"{frame_top}<p>alone</p>"), (91, None, None), (None, "::bad::", "<p>x</p>"),
             rows[3], (92, "http://copy.example/1", "<p>same text</p>"), (93, "http://copy.example/2", "<p>same text</p>")]
    texts = {}
    for r in pages.extract(frame(spark, rows).repartition(5)).collect():
        texts.setdefault(r.page_id, []).append(r.text)
    assert sum(map(len, texts.values())) == len(rows)
    for i in range(30):
        if i != 3:
            assert texts[i] == [f"Story {i} tells of number {i} and its long way home through the town"]
    assert texts[90] == ["Daily News of Town alone"] and texts[91] == [""] and texts[None] == ["x"]
    assert texts[92] == texts[93] == ["same text"]  # a copy says nothing about the frame
    assert pages.extract(frame(spark, [])).count() == 0


def test_differencing_inside_articles_and_under_long_frames():
    page = lambda body: pages.blocks(f"<article><h2>Town news</h2><p>Write to us for the letter</p>{body}</article>")
    one, two = page("<p>The mayor of the town spoke</p>"), page("<p>A bridge was built in May</p>")
    assert pages.main_text(one, [two]) == "Town news The mayor of the town spoke"
    again = page("<p>The mayor of the town spoke</p><p>5 May</p>")
    assert pages.main_text(one, [again]) == "Town news Write to us for the letter The mayor of the town spoke"
    assert pages.main_text(one, [again, two]) == "Town news The mayor of the town spoke"
    frame_text = "<p>" + "All the rights of this site are with its owner. " * 9 + "</p>"
    one, two = (pages.blocks(f"{frame_text}<p>{x} is the whole of the news</p>") for x in ("Rain", "Snow"))
    assert pages.main_text(one, [two]) == "Rain is the whole of the news"


def test_extraction_does_not_depend_on_ranges(spark):
    rows = [(i, f"http://h.example/{i:03d}", f"<div>Top {i // 7}</div><p>Text of page number {i} is here to stay</p>")
            for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, pages.extract(frame(spark, rows)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2]


def test_a_long_row_of_copies_hides_no_page_behind_it(spark):
    """However many copies follow a page, the first other page behind them still tells its frame."""
    top, end = "<div>Daily News of Town</div>", "<div>All rights with us</div>"
    story = [f"{top}<p>The mayor spoke of the long way home</p>{x}{end}" for x in ("", "<p>today</p>")]  # near copies
    rows = [(i, f"http://h.example/a/{i:04d}", story[i % 2] if i < 40 else story[1]) for i in range(700)]
    rows.append((900, "http://h.example/b", f"{top}<p>A bridge was built over the river in May</p>{end}"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r.page_id: r.text for r in pages.extract(frame(spark, rows)).collect()}
            assert got.pop(900) == "A bridge was built over the river in May" and len(got) == 700
            want = ["The mayor spoke of the long way home", "The mayor spoke of the long way home today"]
            assert all(text == want[i % 2 if i < 40 else 1] for i, text in got.items())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_archive_round_trip(spark, tmp_path, min_bytes):
    rows = [(1, "http://a/1", "x" * 10), (2, "http://a/2", "x" * 10), (3, None, None), (4, "http://a/\r\nX: 4", ""),
            (5, "http://é/5", "ä\r\n\r\nWARC/1.1\r\n"), (6, "u", "x" * 10), (None, "n", "x" * 10), (7, "u", "yy"),
            (8, "u", "yy"), (6, "u", "x" * 10), (9, "u", "z" * 100_000)]
    folder = f"file://{tmp_path}/w{min_bytes}"
    manifest = warc.write_archive(frame(spark, rows).repartition(3), folder, min_bytes=min_bytes, roll_bytes=200)
    listed = manifest.collect()
    assert sum(r.records for r in listed) == len(rows) and len(listed) > 1
    names = [n for n in os.listdir(folder[7:]) if n.endswith(".gz")]
    assert sorted(names) == sorted(r.file for r in listed) and not any("temporary" in n for n in names)
    got = sorted(map(tuple, warc.read_archive(spark, folder).select(
        "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "intact").collect()), key=str)
    last = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= min_bytes:
            last[html or ""] = max(i, last.get(html or "", i))
    expected = []
    for i, _, html in rows:
        body = (html or "").encode()
        keep = last.get(html or "")
        refers = keep if i is not None and keep is not None and keep != i and len(body) >= min_bytes else None
        expected.append((i, "revisit" if refers is not None else "response", len(body),
                         base64.b32encode(hashlib.sha1(body).digest()).decode(), refers, True))
    assert got == sorted(expected, key=str)


def test_archive_is_deterministic_and_checked(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"page {i % 5}") for i in range(50)]
    sums = []
    for k in range(2):
        folder = f"file://{tmp_path}/d{k}"
        m = warc.write_archive(frame(spark, rows).repartition(1 + 3 * k), folder)
        sums.append(sorted((r.file, r.sha256) for r in m.collect()))
    assert sums[0] == sums[1]
    with open(f"{tmp_path}/d1/{sums[1][0][0]}", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="differs from its manifest"):
        warc.read_archive(spark, f"file://{tmp_path}/d1").count()
    none = f"file://{tmp_path}/none"
    assert warc.write_archive(frame(spark, []), none).count() == 0 and warc.read_archive(spark, none).count() == 0


def test_articles_of_the_tables_equal_their_documents(spark):
    folder = "/root/testdata/sf0.001"
    whole = {" ".join((r.text or "").split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in queries.op6_html_extraction(spark, folder).collect():
        head = re.search(r"<h1[^>]*>(.*?)</h1>", sources[r.page_id], re.S)
        head = " ".join(entities.unescape(re.sub("<[^>]+>", "", head.group(1))).split()) if head else ""
        assert r.text.startswith(head) and r.text[len(head):].strip() in whole


def test_shared_sentences_of_articles_stay_and_their_frame_goes(spark):
    def page(k, frame_line, sentence=""):
        return f"<article><h1>T{k}</h1><p>Own words of page number {k} come here</p>{sentence}{frame_line}</article>"

    rows = [(i, f"http://few.example/{i}", page(i, "", "<p>Released to all</p>" if i in (2, 3) else "")) for i in range(6)]
    rows += [(100 + i, f"http://many.example/{i:02d}", page(i, "<p>Read more of this</p>")) for i in range(12)]
    rows += [(200 + i, "http://copies.example/a", "<p>Top</p><p>the very same text of a copy</p>") for i in range(9)]
    rows += [(300, "http://copies.example/b", "<p>Top</p><p>but here is quite another text</p>")]
    got = {r.page_id: r.text for r in pages.extract(frame(spark, rows)).collect()}
    assert got[2] == "T2 Own words of page number 2 come here Released to all"
    assert got[0] == "T0 Own words of page number 0 come here"
    assert all(got[100 + i] == f"T{i} Own words of page number {i} come here" for i in range(12))
    # Copies are passed over: the next distinct page of the host shows the frame.
    assert all(got[200 + i] == "the very same text of a copy" for i in range(9))
    assert got[300] == "but here is quite another text"


def test_neighbours_do_not_depend_on_ranges_among_copies(spark):
    rows = [(i, f"http://h.example/{i:03d}", f"<div>Top {i // 9}</div><p>Text {i % 5} of some pages is here to stay</p>")
            for i in range(90)] + [(None, None, None)] * 3
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "4", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(str, pages.extract(frame(spark, rows)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got[0]) == 93 and got[0] == got[1] == got[2]
