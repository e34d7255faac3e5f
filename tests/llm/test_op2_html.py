import html as entities
import re

import pytest

from ingestflow.llm import html_wrappers as hw
from ingestflow.llm.common import Workspace, read_table
from tests.conftest import SF_MID

ROW = "page_id long, url string, html string, text string, host string"


def texts(spark, rows):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], ROW)
    got = hw.main_text(df, hw.infer(df, Workspace(spark, "t")))
    return {r.page_id: r.text for r in got.collect()}


def article_by_hand(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:h1|p)>", body)
    clean = (" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def test_given_pages_against_a_hand_written_rule(spark):
    from ingestflow.llm.queries import op2_main_text
    pages = {r.page_id: r.html for r in read_table(spark, SF_MID, "pages").collect()}
    got = op2_main_text(spark, SF_MID).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article_by_hand(pages[r.page_id])
        assert r.n_chars == len(r.text)


PAGE = """<html><head><title>t {n}</title><style>p{{}}</style></head><body>
<header><h1>Site</h1><a href="/">Home</a></header>
<div class="sidebar"><p>Latest news {n}</p></div>
<div class="notice">We use cookies</div>
<main><article><header><h1>Title {n}</h1></header><p>First &amp; <b>bold</b> para {n}.<p>Second
 one.<ul><li>x {n}<li>y</ul><form><p>Search</p></form>
<section class="comments"><h2>Comments</h2><p>Nice {n}!</p></section></article></main>
<div id="comments"><p>Reader says {n}</p></div>
<footer>Imprint</footer><script>var a="</p>";</script></body></html>"""


def test_boilerplate_goes_and_article_stays(spark):
    got = texts(spark, [(n, f"http://a.example/{n}", PAGE.format(n=n)) for n in range(5)])
    for n in range(5):
        assert got[n] == f"Title {n}\nFirst & bold para {n}.\nSecond one.\nx {n}\ny"


def test_pages_without_semantic_elements_use_the_template(spark):
    page = ("<body><div><a href=1>one</a> <a href=2>two</a></div><div><p>Story {n} is long.</p><p>More {n}.</p>"
            "</div><table><tr><td>All rights reserved by us</td></tr></table></body>")
    got = texts(spark, [(n, "http://b.example/", page.format(n=n)) for n in range(4)])
    assert got[2] == "Story 2 is long.\nMore 2."


def test_edge_cases(spark):
    long = "<article>" + "<p>w x</p>" * 20000 + "</article>"
    got = texts(spark, [
        (1, "http://c.example/1", None), (2, "http://c.example/2", ""), (3, None, "plain &lt;text&gt;"),
        (4, "no host", "<p>unclosed <b>tags<p>here"), (5, "http://d.example/", long),
        (6, "http://e.example/", "<article><p>same</p></article>"),
        (7, "http://e.example/", "<article><p>same</p></article>"),
        (8, "http://f.example/", "<div><p>cut off <a hr"), (None, "http://g.example/", "<p>id?</p>")])
    assert got[1] == got[2] == ""
    assert got[3] == "plain <text>"
    assert got[4] == "unclosed tags\nhere"
    assert got[5].count("\n") == 19999
    assert got[6] == got[7] == "same"
    assert got[8] == "cut off"
    assert got[None] == "id?"


def test_empty_table(spark):
    assert texts(spark, []) == {}


@pytest.mark.parametrize("extra", ["<div>ad</div>", ""])
def test_alignment_gives_optional_and_repeated(extra):
    a = hw.fold(hw.parse(f"<body><h1>t</h1>{extra}<p>a</p><p>b</p></body>"))[0]
    b = hw.fold(hw.parse("<body><h1>t</h1><p>a</p></body>"))[0]
    body = hw.align(a, b)[3][0]
    marks = {c[0]: (c[1], c[2]) for c in body[3]}
    assert marks["h1"] == (0, 0) and marks["p"] == (1, 0)
    assert marks.get("div", (0, 1)) == (0, 1)
    assert hw.align(a, b) == hw.align(hw.align(a, b), b)


def test_wide_hosts_join_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(hw, "BROADCAST_BYTES", 0)
    got = texts(spark, [(n, f"http://a.example/{n}", PAGE.format(n=n)) for n in range(3)])
    assert got[0].startswith("Title 0\n")


def test_every_template_of_a_host_keeps_its_text(spark):
    page = "<body><p><a href=1>Home</a></p>{}<p>Imprint</p></body>"
    forms = ["<article><p>Long article {n} of the host.</p></article>", "<div class='post'><p>Post {n}.</p></div>",
             "<div class='post category-news'><p>News {n}.</p></div>",
             "<div class='post category-sport'><p>Sport {n}.</p></div>", "<p>Plain {n}.</p>"]
    wants = ["Long article {n} of the host.", "Post {n}.", "News {n}.", "Sport {n}.", "Plain {n}."]
    for url in ("http://a.example/", None):
        got = texts(spark, [(10 * k + n, url, page.format(form.format(n=n)))
                            for k, form in enumerate(forms) for n in range(3)])
        for k, want in enumerate(wants):
            for n in range(3):
                assert want.format(n=n) in got[10 * k + n]
                assert k == 4 or got[10 * k + n] == want.format(n=n)


def test_sibling_articles_of_several_classes_stay_together(spark):
    page = ("<body><main><article class='post news'><p>One {n}.</p></article>"
            "<article class='post sport'><p>Two {n}.</p></article></main></body>")
    got = texts(spark, [(n, "http://a.example/", page.format(n=n)) for n in range(3)])
    assert got[1] == "One 1.\nTwo 1."


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><article><p>Story {n}.</p></article></body>",
    "<body class='blog sidebar'><div class='post'><p>Story {n}.</p></div></body>",
    "<body><div class='content no-sidebar'><p>Story {n}.</p></div></body>",
    "<body><main class='with-nav'><p>Story {n}.</p></main></body>",
    "<body><article class='post related'><p>Story {n}.</p></article></body>",
    "<body><div class='widget related'><article><p>Story {n}.</p></article></div><p>Imprint</p></body>",
    "<body><div class='pageNoSidebar'><p>Story {n}.</p></div></body>"])
def test_class_words_do_not_drop_what_holds_the_article(spark, page):
    other = "<body><article><p>Another template {n}, and more of it than of the first.</p></article></body>"
    rows = [(n, "http://a.example/", page.format(n=n)) for n in range(3)] \
        + [(n, "http://a.example/", other.format(n=n)) for n in range(10, 20)]
    got = texts(spark, rows)
    for n in range(3):
        assert got[n] == f"Story {n}."


def test_class_words_still_drop_what_lies_beside_the_article(spark):
    page = ("<body class='with-sidebar'><div class='sidebar'><article><p>Teaser {n} of the week</p></article></div>"
            "<article class='post'><p>The story {n} itself.</p><div class='comments'><p>{noise}</p></div></article>"
            "<div class='related'><p>{noise}</p></div></body>")
    got = texts(spark, [(n, "http://a.example/", page.format(n=n, noise=f"Noise {n}. " * 9)) for n in range(3)])
    assert got[1] == "The story 1 itself."


def test_deep_nesting_beside_a_good_page(spark):
    """Thousands of open elements abort nothing, and their text stays in page order."""
    deep = "<body><article>" + "<div>" * 3000 + "deep one<p>deep two</p>" + "</div>" * 3000 + "<p>after</p></article></body>"
    rows = [(1, "http://d.example/1", deep), (2, "http://d.example/2", "<body><article><p>good page</p></article></body>"),
            (3, "http://d.example/3", "<body><div>" * 2000 + "open ended")]
    got = texts(spark, rows)
    assert got[1] == "deep one\ndeep two\nafter" and got[2] == "good page" and got[3] == "open ended"


def test_content_beside_content_stays(spark):
    page = ('<body><nav>menu</nav><div class="content"><p>First half {n} of the story.</p></div>'
            '<div class="ads">buy</div><article><p>Second half {n} of the story, longer.</p></article></body>')
    got = texts(spark, [(n, f"http://e.example/{n}", page.format(n=n)) for n in range(4)])
    assert got[1] == "First half 1 of the story.\nSecond half 1 of the story, longer."
    # around and within are one content: nothing twice
    page = "<body><main><article><p>Only {n} once.</p></article></main></body>"
    assert texts(spark, [(n, "http://f.example/", page.format(n=n)) for n in range(3)])[2] == "Only 2 once."


def test_quoted_attributes_hold_any_character(spark):
    pages = ["""<p data-x="a > b">Real text.</p>""", """<p title='x > y' class="lead">Real text.</p>""",
             """<p data-x=it's>Real text.</p>""", """<p data-x="never closed>Real text.</p>""",
             """<p a = "1>2" b='3>4'>Real text.</p>"""]
    got = texts(spark, [(n, f"http://g{n}.example/", f"<body><article>{p}</article></body>")
                        for n, p in enumerate(pages)])
    assert set(got.values()) == {"Real text."}


def _table_by_hand(a, b):
    """The pairs of the plain two-dimensional table."""
    def weight(x, y):
        alike = x[3] == y[3] or not x[3] or not y[3] or {c[0] for c in x[3]} & {c[0] for c in y[3]}
        return 1 + 0.5 * bool(alike) if x[0] == y[0] else 0
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            w = weight(a[i], b[j])
            best[i][j] = max(best[i + 1][j + 1] + w if w else 0, best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        w = weight(a[i], b[j])
        if w and best[i][j] == best[i + 1][j + 1] + w:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


@pytest.mark.parametrize("cells", [1 << 22, 40, 1])
def test_alignment_against_the_whole_table(monkeypatch, cells):
    import random
    monkeypatch.setattr(hw, "TABLE_CELLS", cells)
    rng = random.Random(4)

    def some(n):
        return [[rng.choice("abc"), 0, 0, [[rng.choice("xyz"), 0, 0, []] for _ in range(rng.randint(0, 2))]]
                for _ in range(n)]

    for _ in range(60):
        a, b = some(rng.randint(0, 24)), some(rng.randint(0, 24))
        if [x[0] for x in a] != [y[0] for y in b]:
            assert hw._matches(a, b) == _table_by_hand(a, b)


def test_long_pages_of_pairs_take_no_square_of_time():
    import time
    trees = [hw.fold(hw.parse("<body><article>" + "".join(f"<h2>h{i}</h2><p>p{i}</p>" for i in range(n))
                              + "</article></body>"))[0] for n in (1500, 1400)]
    start = time.process_time()
    both = hw.align(*trees)
    assert time.process_time() - start < 10 and len(both[3][0][3][0][3]) >= 2800


def test_random_templates(spark):
    """Inference on random templates gives back exactly the texts that were put into the article."""
    import random
    rng = random.Random(7)
    rows, expected = [], {}
    for host in range(6):
        before = [rng.choice(["<nav><a href=x>Home</a> <a href=y>News</a></nav>", "<header><b>Site</b></header>",
                              "<div class='sidebar'><p>latest</p></div>", "<div role=search>find</div>"])
                  for _ in range(rng.randint(0, 3))]
        after = [rng.choice(["<footer>imprint</footer>", "<section id=comments><p>reader {n}</p></section>",
                             "<aside><p>more {n}</p></aside>"]) for _ in range(rng.randint(0, 3))]
        tag = rng.choice(["<article>|</article>", "<main>|</main>", "<div class='post'>|</div>"])
        optional = [rng.choice(["h2", "ul", "blockquote", "table"]) for _ in range(2)]
        for n in range(8):
            page_id, blocks, inner = host * 100 + n, [f"Title {host} {n}"], [f"<h1>Title {host} {n}</h1>"]
            for k in range(rng.randint(1, 5)):
                blocks.append(f"par {host} {n} {k} with words")
                inner.append(f"<p>par {host} {n} {k} <b>with</b> words</p>")
                for o in optional:
                    if rng.random() < 0.4:
                        text = f"{o} {host} {n} {k}"
                        blocks.append(text)
                        inner.append({"ul": f"<ul><li>{text}</ul>", "table": f"<table><tr><td>{text}</table>"}.get(
                            o, f"<{o}>{text}</{o}>"))
            expected[page_id] = "\n".join(blocks)
            rows.append((page_id, f"http://h{host}.example/{n}", "<body>" + "".join(before).replace("{n}", str(n))
                         + tag.replace("|", "".join(inner)) + "".join(after).replace("{n}", str(n)) + "</body>"))
    assert texts(spark, rows) == expected
