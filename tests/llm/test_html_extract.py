import html
import re

from lakeloom.llm import html_extract as h


def slow(page):
    """The generator's own template: everything in <article>, by its block tags."""
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:h1|p)>|<br>", inner)
    texts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_pages(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = h.op5_tag_path_ratios(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, slow(pages[r.page_id].html), len(r.text))


PAGE = """<html><head><title>T</title></head><body><header><h1>Site name</h1></header>
<div id="cookie-notice">We use cookies, please accept them all, thank you.</div><ul class='menu'><li><a href=x>One</a><li><a>Two</a></ul>
<div class="content"><h2>Head&amp;line</h2><p>First   paragraph, with words; and more words than that, surely.
<p>Second <b>bold&nbsp;text</b> is here, it has <a href="y">a link</a> and commas, too.<script>if (a<b) x("</p>")</script>
<blockquote>Quoted, short.</blockquote><div class="share">Share this, now!</div></div>
<div class="sidebar"><p>Other stories, which are long, and have punctuation, to trick us all.</p></div>
<form>Name <input></form><div id=comments><p>Nice article, I liked it a lot, really.</p></div><footer>Imprint, 2020.</footer></body></html>"""


def test_other_templates():
    want = ["Head&line", "First paragraph, with words; and more words than that, surely.",
            "Second bold text is here, it has a link and commas, too.", "Quoted, short."]
    assert h.main_text(PAGE).split("\n") == want


def test_odd_pages(spark):
    odd = [None, "", "   ", "plain text, no tags", "<p>a<p>b", "<!-- <p>x", "<p>ok</p><script>never", "<a <a <a" * 50_000, '<p class="x>' * 20_000,
           "</div></p>text</p>", "<p>1 < 2 &lt; 3</p>", "<div>" * 5_000 + "deep", "<P>Caps</P>", "<p>dup</p>", "<p>dup</p>", "<p>" + "long, " * 60_000]
    df = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").selectExpr("*", "'u' as url", "1 as text", "2 as id")
    got = {r.id: r.text for r in h.extract(df).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 4, 5)] == ["", "", "", "plain text, no tags", "a\nb", ""]
    assert got[6] == "ok" and got[10] == "1 < 2 < 3" and got[11] == "deep" and got[12] == "Caps" and got[13] == got[14] == "dup"
    assert len(got[15]) == 6 * 60_000 - 1 and len(got) == len(odd)
    assert h.extract(df.limit(0)).count() == 0


def paragraph(k, n=100):
    return (f"Number {k}, so it is said, has words " + "and more words " * n)[: n - 1] + "."


def page(body):
    return f"<html><body><div class='top'><a href=/>Home</a></div>{body}<div><a href=/x>Next</a></div></body></html>"


def test_nothing_beside_the_largest_element_is_lost():
    few, items = [paragraph(k) for k in range(10)], [paragraph(k, 400).replace("words", "words,", 10) for k in range(20, 23)]
    ps = lambda texts: "".join(f"<p>{t}</p>" for t in texts)
    title, lis = "<h1>Title</h1>", "<ul>" + "".join(f"<li>{t}</li>" for t in items) + "</ul>"
    cells = "<table>" + "".join(f"<tr><td>{t}</td></tr>" for t in items) + "</table>"
    terms = "<dl>" + "".join(f"<dd>{t}</dd>" for t in items) + "</dl>"
    for wrap in ("<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "{}"):
        for more in (lis, cells, terms, f"<section>{ps(items)}</section>", f"<div>{'<br>'.join(items)}</div>"):
            got = h.main_text(page(wrap.format(title + ps(few) + more)))
            assert got.replace("\n", " ") == " ".join(["Title", *few, *items]), (wrap, more[:20])
        parts = f"<div>{ps(few[:8])}</div><div>{ps(few[8:])}</div>"
        assert h.main_text(page(wrap.format(title + parts))).split("\n") == ["Title", *few]
    assert h.main_text(page(f"<div>{title}<div>{ps(few)}</div></div>")).split("\n") == ["Title", *few]
    assert h.main_text(page(f"{title}<div>By, me</div><article>{ps(few)}</article>")).split("\n") == ["Title", *few]
    assert h.main_text(page(f"<div>{ps(few)}</div><article>{few[0]}</article>")).split("\n") == [*few, few[0]]


def test_names_are_votes():
    few = [paragraph(k) for k in range(10)]
    ps = "".join(f"<p>{t}</p>" for t in few)
    out = '<div class="sidebar"><p>Other stories, which are long.</p></div>'
    for name in ("site has-sidebar", "content-with-sidebar", "layout-right-sidebar", "page no-comments", "entry has-related", "sidebar", "comments"):
        for inner in (f"<div>{ps}</div>", f"<article>{ps}</article>"):
            assert h.main_text(page(f"<div class='{name}'>{inner}{out}</div>")).split("\n") == few, name
    for name in ("discussion", "navy", "promoted-by", "tags", "notice", "menuhin"):
        for wrap in ("<article>{}</article>", "<div>{}</div>"):
            part = f"<div id='{name}' class='{name}'><p>{few[0]}</p></div>"
            assert h.main_text(page(wrap.format(part + ps))).split("\n") == [few[0], *few], name
    assert h.main_text(page(f"<form>{ps}</form>")).split("\n") == few
    assert h.main_text(f"<div class=share><p>{few[0]}</p></div><div class=login><p>{few[1]}</p></div>").split("\n") == few[:2]
    for name in ("sidebar", "left-sidebar", "cookie-notice", "comments-area", "site-nav", "comment-2"):
        assert h.main_text(page(f"<article>{ps}</article><div class={name}><p>{few[0]}</p></div>")).split("\n") == few
        assert h.main_text(page(f"<div>{ps}</div><div class={name}><p>{few[0]}</p></div>")).split("\n") == few


def test_depth_changes_nothing():
    few = [paragraph(k) for k in range(6)]
    ps = "".join(f"<p>{t}</p>" for t in few)
    for depth in (1, 100, 600, 30_000):
        deep, shut = "<div>" * depth, "</div>" * depth
        side = f"<nav><p>{few[0]}</p></nav><div class=sidebar><p>Other, stories.</p></div><div hidden><p>Unseen, text.</p></div>"
        assert h.main_text(f"<html><body>{deep}{side}<h1>Title</h1>{ps}{shut}</body></html>").split("\n") == ["Title", *few], depth
    assert h.main_text("<ul><li>" * 40_000 + f"<p>{few[0]}</p>").endswith(few[0])


def without_names(monkeypatch):
    """The ratios alone: no tag, role, class, id or attribute says what is outside."""
    never = re.compile("(?!)")
    for name in ("_OUTSIDE", "_VOTED", "_ROLES"):
        monkeypatch.setattr(h, name, frozenset())
    for name in ("_NAMES", "_MAYBE", "_ATTRIBUTE"):
        monkeypatch.setattr(h, name, never)


def test_pages_by_ratios_alone(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    without_names(monkeypatch)
    same = sum(h.main_text(r.html) == slow(r.html) for r in pages)
    assert same >= 0.98 * len(pages), (same, len(pages))


def test_ratios_alone_remove_blocks(monkeypatch):
    few = [paragraph(k) for k in range(8)]
    ps = "".join(f"<p>{t}</p>" for t in few)
    links = "<ul>" + "".join(f"<li><a href=/{k}>Story number {k}</a></li>" for k in range(12)) + "</ul>"
    for body in (f"<div>{links}<div>{ps}</div></div>", f"<div><div>{ps}</div>{links}</div>", f"<article>{ps}{links}</article>"):
        assert h.main_text(page(body)).split("\n") == few, body[:20]
    without_names(monkeypatch)
    assert h.main_text(page(f"<nav>{links}</nav><div>{ps}</div><footer><span>Imprint</span></footer>")).split("\n") == few


LISTS = {
    "dl": ("<dl><dt>Weight<dd>5 kg<dt>Height<dd>2 m<dt>Made in<dd>Ulm</dl>", ["Weight", "5 kg", "Height", "2 m", "Made in", "Ulm"]),
    "table": ("<table><tr><th>Weight<td>5 kg<tr><th>Height<td>2 m</table>", ["Weight", "5 kg", "Height", "2 m"]),
    "ul": ("<ul><li>Salt<li>Two eggs<li>Milk<li>Flour<li>Oil</ul>", ["Salt", "Two eggs", "Milk", "Flour", "Oil"]),
    "nested": ("<ul><li>Dough<ul><li>Salt<li>Milk</ul><li>Top<ul><li>Oil</ul></ul>", ["Dough", "Salt", "Milk", "Top", "Oil"]),
}


def test_lists_and_tables_after_headings_stay():
    texts = [paragraph(k) for k in range(5)]
    for around in ("<article>{}</article>", "<main>{}</main>", "<div class='post'>{}</div>"):
        for heads in ([], ["h2"], ["h2", "h3"]):
            for body, want in LISTS.values():
                titles = "".join(f"<{t}>{t} title</{t}>" for t in heads)
                got = h.main_text(page(around.format("".join(f"<p>{t}</p>" for t in texts) + titles + body)))
                assert got.split("\n") == texts + [f"{t} title" for t in heads] + want, (around, heads, body)


def test_long_comments_and_sidebars_go():
    texts, others = [paragraph(k) for k in range(2)], [paragraph(k, 150) for k in range(30, 42)]
    ps = lambda texts: "".join(f"<p>{t}</p>" for t in texts)
    for name in ("class='comments'", "class='sidebar'", "id=comments", "class='post-replies'", "id='right-sidebar'"):
        away = f"<div {name}>{ps(others)}</div>"
        for body in (f"<article>{ps(texts)}</article>{away}", f"{away}<main>{ps(texts)}</main>", f"<article>{ps(texts)}{away}</article>", f"<div class='story'>{ps(texts)}</div>{away}", f"<div>{ps(texts)}{away}</div>"):
            assert h.main_text(page(body)).split("\n") == texts, (name, body[:60])
    for name in ("class='social'", "id='newsletter'"):  # beside an article no name is spared for its length, but the article's own text is
        assert h.main_text(page(f"<article>{ps(texts)}</article><div {name}>{ps(others)}</div>")).split("\n") == texts
        assert h.main_text(page(f"<article><h1>T</h1><div {name}>{ps(texts)}</div></article>")).split("\n") == ["T", *texts]
    assert h.main_text(page(f"<div class='comments'>{ps(texts)}</div>")) != ""  # nothing else would be left


def test_formulas_and_references_stay():
    texts = [paragraph(k) for k in range(3)]
    body = "".join(f"<p>{t}</p>" for t in texts) + "<p>Let <math><mi>x</mi></math> be one, so it is.</p>"
    refs = "<h2>References</h2><ul><li><a href=a>First source</a><li><a href=b>Second source</a></ul>"
    links = "<ul><li><a href=a>Home</a><li><a href=b>Archive</a></ul>"
    got = h.main_text(page(f"<article>{links}{body}{refs}</article>")).split("\n")
    assert got == [*texts, "Let x be one, so it is.", "References", "First source", "Second source"]
