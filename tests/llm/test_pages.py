"""Operators on pages against what the pages were made of."""

import hashlib

import pytest

from tallywire.llm import warc, wrappers

PAGES = "page_id long, url string, html string, id long, host string, shape string, file string, start long"


def pages(spark, made):
    return spark.createDataFrame([(i, u, h, 1, "x", "y", "z", 2) for i, u, h in made], PAGES)


def page(i, extra="", body=None):
    said = body or f"<h1>Title {i}</h1><p>First &amp; <b>bold</b> text\n of {i}.<p>Second&nbsp;para &lt;{i}&gt;<ul><li>one {i}<li>two {i}</ul>"
    return (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><nav><a>menu {i}</a></nav>"
        f"<div class='cookie-notice'>We use cookies {i}</div><article>{said}<p class=closing>Join our list now.</p>{extra}"
        f"<div id='comments'><article><p>reader {i}</p></article></div><form><p>your mail {i}</p></form></article><aside>side {i}</aside>"
        f"<script>if (a < b) document.write('<p>no</p>')</script><footer>foot {i}</footer></body></html>"
    )


def text(i):
    return f"Title {i}\nFirst & bold text of {i}.\nSecond para <{i}>\none {i}\ntwo {i}"


def test_extraction(spark):
    made = [(i, f"https://a.example/{i}", page(i, f"<div class=x{i}><p>more {i}</p></div>" if i % 3 == 0 else "<p>Read also our weekly letter.</p>")) for i in range(40)]
    made += [(100 + i, f"https://b.example/{i}", page(7)) for i in range(9)]
    made += [(200, None, None), (201, "odd", ""), (202, "https://c.example", "<p>open <i>text"), (203, "https://c.example", "just < text &copy; &#233;")]
    made += [(204, "https://d.example", "<div>" * 3000 + "deep" + "</div>" * 3000 + "after"), (None, "https://c.example", "<table><tr><td>a<td>b</table>x<br>y")]
    made += [(202, "https://c.example", "<p>open <i>text")]
    found = {}
    for r in wrappers.extract(pages(spark, made)).collect():
        found[r.page_id] = r.text
    for i in range(40):
        # The line that all pages of the host carry is part of the template, whichever element holds it.
        rest = f"\nmore {i}" if i % 3 == 0 else "\nRead also our weekly letter."
        assert found[i] == text(i) + rest
    # Equal pages are one page, so nothing on them is known to be constant.
    assert found[100] == text(7) + "\nJoin our list now."
    assert found[200] == "" and found[201] == "" and found[202] == "open text"
    assert found[203] == "just < text © é" and found[204] == "deep\nafter" and found[None] == "a\nb\nx y"
    assert wrappers.extract(pages(spark, [])).count() == 0


def blocks_of(page):
    return [t for n, t in wrappers.parse(page)[1] if not n.off]


def test_rest_of_page_behind_drawings_buttons_and_deep_blocks():
    assert blocks_of("<p>a <svg/> b</p><p>c</p>") == ["a b", "c"]
    assert blocks_of("<p>a <svg><path/><text>no</text></svg> b <button>no</button> c</p><math><mi>x</math><p>d") == ["a b c", "d"]
    assert blocks_of("<p>a <svg><path><p>b<p>c") == ["a", "b", "c"]
    for tag in ("button", "select", "object", "svg", "math"):
        assert blocks_of(f"<div><{tag} class=x>no</div><p>text</p><div>more</div>") == ["text", "more"]
        assert blocks_of(f"<div><{tag}>no</div><p>text</p><{tag}><div>no</div></{tag}><p>more</p>")[-1] == "more"
    assert blocks_of("<div><button>no<p>text</p><button>no</button><p>more</p></div>") == ["text", "more"]
    deep = "<div>" * 150
    assert blocks_of(deep + "<p>one</p><nav>no</nav><div class=ad>no</div><p>two</p>") == ["one", "two"]
    assert blocks_of(deep + "<div class=ad><div>no</div>no</div>" + "</div>" * 150 + "after") == ["after"]


def test_names_inside_an_article():
    kept = "<section id='related-work'><p>a</p></section><h2 id='login-flow'>b</h2><div id='social-history'>c</div>"
    kept += "<p id='share-prices'>d <span id='alert-levels'>e</span></p>"
    dropped = "<div class='share-buttons'>no</div><div class='x related'>no</div><div id='comments'>no</div><ul class='related-posts'><li>no</ul>"
    assert blocks_of(f"<article>{kept}{dropped}</article>") == ["a", "b", "c", "d e"]
    assert blocks_of("<div><p>main</p></div><article class='comment'>no</article><article id='comment-12'>no</article>") == ["main"]


LONG_TEXT = "A long text of many words that is what the page is about."


@pytest.mark.parametrize(
    "frame",
    ["<div class='content-area no-sidebar'>", "<div class='layout-sidebar-right'>", "<div id=wrapper class='nav-open'>", "<form id='aspnetForm'>",
     "<div class='page-with-sidebar'><form role=form>", "<div class=sidebar>", "<div id='has-banner'>"],
)
@pytest.mark.parametrize("inner", ["<article><p>{}</p></article>", "<p>{}</p>"])
def test_frames_of_a_page_are_content(frame, inner):
    side = "<div class=sidebar>Side.</div><div class='main-nav'>Go</div><form>Ask</form><div class='site_footer'>End</div><div id=comments>Me too.</div>"
    assert blocks_of(f"<body>{frame}{inner.format(LONG_TEXT)}{side}") == [LONG_TEXT]


def test_comments_are_never_content_however_long():
    assert blocks_of(f"<p>Short.</p><div class='comment-list'><p>{LONG_TEXT * 5}</p></div>") == ["Short."]
    assert blocks_of(f"<article><p>Short.</p><section class='comments'><p>{LONG_TEXT * 5}</p></section></article>") == ["Short."]


def test_equal_articles_and_bylines_stay(spark):
    """Pages of a host that differ in their menus alone, and bylines that are equal on all pages."""
    made = [(i, f"https://same.example/{i}", f"<div><ul class=x><li>Go {i}</li></ul></div><div><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></div>") for i in range(6)]
    line = "<article><p class='byline'>By Jo Doe</p><p>Text {0} of the host, which is its own.</p><p>Subscribe now.</p></article>"
    made += [(100 + i, f"https://by.example/{i}", line.format(i)) for i in range(7)]
    for r in wrappers.extract(pages(spark, made)).collect():
        if r.page_id < 100:
            assert r.text == f"Go {r.page_id}\n{LONG_TEXT}\n{LONG_TEXT}"
        else:
            assert r.text == f"By Jo Doe\nText {r.page_id - 100} of the host, which is its own."


def test_pages_meet_wrappers_without_being_sent_them(spark, monkeypatch):
    made = [(i, f"https://h{i % 3}.example/{i}", f"<div><p>Text {i} of this host.</p><p>Fixed.</p></div>") for i in range(24)]
    sent = sorted(map(tuple, wrappers.extract(pages(spark, made)).collect()))
    monkeypatch.setattr(wrappers, "MOST_BYTES", 0)
    assert sorted(map(tuple, wrappers.extract(pages(spark, made)).collect())) == sent
    assert all(r[2] == f"Text {r[0]} of this host." for r in sent)


def test_places_on_pages_of_any_length(spark):
    def body(i, sections):
        return "".join(f"<h2>Part {i} {k}</h2><p>Text {i} {k}.</p>" for k in range(sections))

    made = [(i, f"https://long.example/{i}", f"<article>{body(i, 2 + 3 * i)}<p>Fixed line.</p></article>") for i in range(12)]
    for r in wrappers.extract(pages(spark, made)).collect():
        assert r.text.split("\n") == [t for k in range(2 + 3 * r.page_id) for t in (f"Part {r.page_id} {k}", f"Text {r.page_id} {k}.")]


def test_templates_of_layouts_languages_and_small_hosts(spark):
    fixed = {"en": "Read on.", "de": "Weiter lesen.", "fr": "Lire la suite."}

    def said(i, lang, kind="a"):
        return f"<html lang={lang}><body><div class={kind}><p>Text number {i} of this host.</p><p>{fixed[lang]}</p><p>Always here.</p></div></body></html>"

    made = [(i, f"https://mixed.example/{i}", said(i, ["en", "en", "en", "de", "fr"][i % 5])) for i in range(40)]
    # A line of one layout of three, and hosts of two pages: different ones, and copies but for a word.
    made += [(100 + i, f"https://three.example/{i}", said(i, "en", "xyz"[i % 3]).replace("Always here.", f"Part {i % 3}.")) for i in range(30)]
    made += [(200 + i, f"https://two.example/{i}", said(i, "en")) for i in range(2)]
    made += [(300 + i, f"https://copy.example/{i}", f"<p>A long text of many words that stands twice.</p><p>Word {i}.</p>") for i in range(2)]
    found = {r.page_id: r.text for r in wrappers.extract(pages(spark, made)).collect()}
    for i, text in found.items():
        assert text == (f"A long text of many words that stands twice.\nWord {i - 300}." if i >= 300 else f"Text number {i % 100} of this host.")
    assert len(found) == len(made)


def test_simple_tree_matching():
    leaf = lambda x: (x, ())
    a = ("body", (leaf("nav"), ("div", (leaf("h1"), leaf("p"))), leaf("footer")))
    b = ("body", (("div", (leaf("h1"), leaf("img"), leaf("p"))), leaf("footer"), leaf("script")))
    assert wrappers.matching(a[1], b[1]) == [(1, 0), (2, 1)]
    assert wrappers.nodes_matched(a, b) == 5
    merged = wrappers.merge(a, b)
    assert merged == ("body", (leaf("nav"), ("div", (leaf("h1"), leaf("img"), leaf("p"))), leaf("footer"), leaf("script")))
    assert wrappers._load(wrappers._dump(merged)) == merged


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_archives(spark, small_splits):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 99999\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    bodies = ["", "short", "short", "x" * 120, "x" * 120, None, inner * 30, "a" + inner + "é" * 700, "WARC/1.1\r\n" * 200, inner, inner * 30, "y\n" * 400]
    made = [(i, f"https://e.example/{i} q\r\nx", b) for i, b in enumerate(bodies * 3)] + [(None, None, "null id"), (5, "https://e.example", bodies[6])]
    found = warc.archive_round_trip(pages(spark, made)).collect()
    assert all(r.valid for r in found)
    first = {}
    for i, _, b in made:
        if i is not None and len((b or "").encode()) >= 100:
            first[b] = min(first.get(b, i), i)
    expected = []
    for i, _, b in made:
        raw = (b or "").encode()
        to = first.get(b) if i is not None and first.get(b, i) != i else None
        expected.append(str((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to)))
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in found) == sorted(expected)
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_broken_archives(spark, tmp_path):
    good = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: {}\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((good.format(1) + good.format(2) + "junk" + good.format(3)).encode())
    (tmp_path / "b.warc").write_bytes(("no magic here\n" + good.format(4)).encode())
    (tmp_path / "c.warc").write_bytes((good.format(5) + "WARC/1.1\r\nContent-Length: x\r\n\r\n" + good.format(6)).encode())
    found = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in found) == [1, 2, 5]
