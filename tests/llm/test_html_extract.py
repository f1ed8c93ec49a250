"""Pages, tree matching and wrappers."""

import html
import itertools
import random
import re

import pytest

from amendry.llm import html_extract
from amendry.llm.html_extract import Page, align
from amendry.llm.queries import REGISTRY

ROLES = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav>menu</nav><div class="content-sidebar">
<article class="post"><header><h2>T &amp; t&nbsp;x</h2><p>By me</p></header>a<p>one <b>two</b><span class="ad">buy</span> three<br>four
<ul><li>x<li>y</ul><script>var a="</p>"</script><form>f</form><aside>s</aside><div class="comments"><p>c</p></div>
<table><tr><td>1<td>2</table><div role="alert">n</div>tail</article></div><div id="page-header">ph</div><div id="sidebar">sb</div><footer>f</footer>"""


def whole(page):
    return "\n".join(line for _, _, line in Page(page).lines())


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b<div>c<div class=menu>d</div></div><a href='x>y'>l</a> &lt;x&gt; 1 < 2", "a\nb\nc\nl <x> 1 < 2"),
        (ROLES, "T & t x\na\none two three four\nx\ny\n1\n2\ntail"),
        ("<main><p>m</p><article>a</article></main>", "a"),
        ("<main><p>m</p></main><p>o</p>", "m"),
        ("<article><p>a</p><article class='comment'>c</article></article>", "a"),
        ("<style>p{}</style><!-- <p>x</p> --><p>&#233;&eacute &amp</p><textarea>t</textarea>", "éé &"),
        ("<p>a <b>b<p>c</b> d", "a b\nc d"),
        ("<article><p>open", "open"),
        ("<div class='header'><p>Top</p></div><div class='entry'><h1>T</h1><p>x</p></div>", "T\nx"),
        ("<article><div class='post-header'><h1>T</h1><span>by</span><p>me</p></div><p>x</p></article>", "T\nx"),
        ("<div class='with-header'><main><p>x</p></main></div>", "x"),
        ("<article><section id='related-work'><p>a</p></section><p class='share-price'>b</p></article>", "a\nb"),
        ("<article><div class='ad-hoc'>a</div><div class='research-search'>b</div><div class='ad_box'>c</div></article>", "a\nb"),
        ("<form><div id=top>t</div><article><p>a</p><form>f</form></article></form>", "a"),
        ("<form id=page><nav>n</nav><h1>T</h1><p>a</p><footer>f</footer></form>", "T\na"),
        ("<p>a</p><form><p>Your name</p><button>Send</button></form>", "a"),
        ("<p>a</p><div class='social-share-buttons'>s</div><div id='main-nav'>n</div><div class='related-posts'>r</div>", "a"),
    ],
)
def test_content_of_single_pages(page, text):
    assert whole(page) == text


def test_long_and_deep_pages():
    assert whole("<div>" * 20000 + "x") == "x"
    assert whole("<p>w</p>" * 20000).count("w") == 20000
    assert whole('<a href="' * 2000) is not None


def plain_align(a, b):
    """Size of the best matching of two folded trees, by trying all ordered choices of children."""
    left, right = html_extract._read_tree(a), html_extract._read_tree(b)

    def best(x, y):
        if left.signatures[x] != right.signatures[y]:
            return 0
        top, xs, ys = 0, left.children[x], right.children[y]
        for n in range(1, min(len(xs), len(ys)) + 1):
            for p, q in itertools.product(itertools.combinations(xs, n), itertools.combinations(ys, n)):
                got = [best(i, j) for i, j in zip(p, q)]
                top = max(top, sum(got)) if all(got) else top
        return 1 + top

    return best(0, 0)


def test_simple_tree_matching_is_maximal():
    draw = random.Random(6)

    def tree():
        lines, used = [], {0: set()}
        for _ in range(draw.randint(0, 9)):
            parent, name = draw.choice(sorted(used)), draw.choice("abcd")
            if name not in used[parent]:
                used[parent].add(name)
                lines.append(f"{parent} {name}")
                used[len(lines)] = set()
        return "\n".join(lines)

    for _ in range(300):
        a, b = tree(), tree()
        match = align(a, b)
        assert len(match) == plain_align(a, b)
        assert len(set(match.values())) == len(match)


def site(k, host="http://h.example/", extra=""):
    return f"{host}{k}", f"<div class='top'>Welcome to us</div><div class='body'><h1>Title {k}</h1><p>Words {k * k} here</p></div><div class='low'>About{extra}</div>"


def test_constant_nodes_are_template(spark):
    rows = [(k, *site(k)) for k in range(20)] + [(50, *site(3))] * 30
    rows += [(60 + k, *site(k, "http://few.example/")) for k in range(3)]  # too few to tell
    rows += [(70 + k, f"http://same.example/{k}", site(1)[1]) for k in range(20)]  # copies teach nothing
    rows += [(90, None, None), (91, "http://h.example/x", None), (92, "http://h.example/y", "<p>Other</p>"), (93, *site(99, extra=" you"))]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    found = html_extract.add_text(df)
    assert found.columns == ["page_id", "url", "html", "text"]
    got = {r["page_id"]: r["text"] for r in found.collect()}
    assert found.count() == len(rows)
    for k in range(20):
        assert got[k] == f"Title {k}\nWords {k * k} here"
    assert got[50] == got[3]
    assert got[60] == "Welcome to us\nTitle 0\nWords 0 here\nAbout"
    assert got[70] == "Welcome to us\nTitle 1\nWords 1 here\nAbout"
    assert (got[90], got[91], got[92]) == ("", "", "Other")
    assert got[93] == "Title 99\nWords 9801 here\nAbout you"
    assert html_extract.add_text(df.limit(0)).count() == 0


def test_query_on_whole_table(spark):
    """The test pages name their article; its headings and paragraphs are what is left."""
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = REGISTRY["op1_html_extraction"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [re.sub("<[^>]*>", "", p.replace("<br>", " ")) for p in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert r["n_chars"] == len(r["text"])


def extracted(spark, pages, **options):
    """Texts of pages given as (url, html), in order."""
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html_extract.add_text(df, **options).orderBy("page_id").collect()]


@pytest.mark.parametrize(
    "page",
    [
        "<div>Site menu</div><div>{}</div><div>Copyright</div>",
        "<div id=top>Site menu</div><div id=content>{}</div><div id=low>Copyright</div>",
        "<p>Site menu</p>{}<p>Copyright</p>",
        "<table><tr><td>Site menu<tr><td>{}<tr><td>Copyright</table>",
    ],
)
def test_constant_siblings_have_slots_of_their_own(spark, page):
    bodies = [[f"Article {k} {j}" for j in range(1 + k % 4)] for k in range(20)]
    between = "</p><p>" if page.startswith("<p>") else "<br>"
    pages = [(f"http://h.example/{k}", page.format(("<p>%s</p>" if page.startswith("<p>") else "%s") % between.join(b))) for k, b in enumerate(bodies)]
    glue = "\n" if page.startswith("<p>") else " "
    assert extracted(spark, pages) == [glue.join(b) for b in bodies]


def test_long_lists_of_children_are_aligned_in_parts(monkeypatch):
    draw = random.Random(3)
    for _ in range(50):
        a, b = ("\n".join(f"0 {draw.choice('pqr')}" for _ in range(draw.randint(1, 30))) for _ in range(2))
        whole = len(align(a, b))
        monkeypatch.setattr(html_extract, "CELLS", 4)
        assert len(align(a, b)) == whole
        monkeypatch.undo()


def test_few_pages_and_several_wordings_make_a_wrapper(spark):
    page = "<div class=top>{}</div><div class=body>Words {}</div><div class=low>About</div>"
    wording = lambda k: "Long notice" if k % 5 < 3 else "Short notice"
    pages = [(f"http://two.example/{k}", page.format("Hello", k)) for k in range(2)]
    pages += [(f"http://seven.example/{k}", page.format("Hello", k)) for k in range(7)]
    pages += [(f"http://words.example/{k}", page.format(wording(k), k)) for k in range(10)]
    pages += [(f"http://copy.example/{k}", page.format("Hello", max(k, 1))  + "<p>x" * (k == 0)) for k in range(10)]  # a near copy
    pages += [("http://one.example/", page.format("Hello", 0))]
    got = extracted(spark, pages, least=2)
    assert got[:19] == [f"Words {k}" for n in (2, 7, 10) for k in range(n)]
    assert got[19:29] == ["Words 1\nx", *[f"Words {max(k, 1)}" for k in range(1, 10)]]
    assert got[29] == "Hello\nWords 0\nAbout"


def test_query_learns_from_two_pages(spark, tmp_path):
    page = "<div class=top>Hello</div><div class=body>Words {}</div>"
    rows = [(k, f"http://h.example/{k}", page.format(k)) for k in range(2)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(r["text"] for r in REGISTRY["op1_html_extraction"](spark, str(tmp_path)).collect()) == ["Words 0", "Words 1"]


def test_every_layout_of_a_host_has_a_wrapper(spark):
    article = "<div class=top>Hello</div><div class=body>Words {0}</div>"
    listing = "<section class=list><h1>Archive</h1><p>Entry {0}</p></section><section class=low>Older posts</section>"
    pages = [(f"http://h.example/{k}", (article if k % 10 < 6 else listing).format(k)) for k in range(40)]
    # optional blocks: every page has a tree of its own, and none has all
    some = [[f"<div class=o{chr(97 + j)}>Block {j}</div>" for j in range(6) if (k >> j) & 1] for k in range(1, 40)]
    pages += [(f"http://own.example/{k}", "".join(blocks) + f"<div class=body>Words {k}</div>") for k, blocks in enumerate(some)]
    got = extracted(spark, pages, least=2)
    assert got == [f"{'Words' if k % 10 < 6 else 'Entry'} {k}" for k in range(40)] + [f"Words {k}" for k in range(39)]


def test_merged_trees_hold_both():
    draw = random.Random(8)

    def tree():
        lines = []
        for k in range(draw.randint(0, 12)):
            lines.append(f"{draw.randint(0, k)}{draw.choice(['', '', '=1', '=2,3'])} {draw.choice('ab')}")
        return "\n".join(lines)

    for _ in range(300):
        a, b = tree(), tree()
        merged = html_extract._merge(html_extract._read_tree(a), html_extract._read_tree(b))
        whole = [len(html_extract._read_tree(t).signatures) for t in (a, b, merged)]
        assert whole[2] == whole[0] + whole[1] - len(align(b, a))


def test_texts_that_few_pages_share_stay(spark):
    """Two or three pages: a shared paragraph, and one body under three footers."""
    page = "<div><p>Title {0}</p><p>{1}</p><p>Last words of {0}</p></div>"
    shared = [("http://three.example/a", page.format("one", "A paragraph that two pages share")),
              ("http://three.example/b", page.format("two", "A paragraph that two pages share")),
              ("http://three.example/c", page.format("three", "Something else"))]
    pair = [(f"http://pair.example/{k}", f"<p>Menu</p><h1>Title {k}</h1><p>Shared paragraph</p><p>Own words {k}</p><p>Low</p>") for k in range(2)]
    body = [(f"http://body.example/{k}", f"<p>The same long body on every page</p><p>Low {k}</p>") for k in range(3)]
    got = extracted(spark, shared + pair + body, least=2)
    assert got[:3] == ["Title one\nA paragraph that two pages share\nLast words of one",
                       "Title two\nA paragraph that two pages share\nLast words of two", "Title three\nSomething else\nLast words of three"]
    assert got[3:5] == [f"Title {k}\nShared paragraph\nOwn words {k}" for k in range(2)]
    assert got[5:] == [f"The same long body on every page\nLow {k}" for k in range(3)]


def sites(draw):
    """Sites without <article> and without telling class names: (url, html, main text), from a plain generator."""
    words = "lake river stone wind bridge paper silver window garden winter morning letter road cloud table yellow".split()
    sentence = lambda: " ".join(draw.choice(words) for _ in range(draw.randint(4, 12))).capitalize() + f" {draw.randint(0, 10**6)}."
    for host in range(6):
        menu = "".join(f"<li>{draw.choice(words)} {k}</li>" for k in range(draw.randint(3, 6)))
        low, notice = f"Imprint of site {host}", [f"Notice {host} {k}" for k in range(1 + host % 3)]
        box, part = draw.choice([("div", "p"), ("section", "p"), ("td", "div")])
        for k in range(draw.randint(12, 30)):
            body = [f"Title {host} {k}", *[sentence() for _ in range(draw.randint(1, 6))]]
            inner = f"<h2>{body[0]}</h2>" + "".join(f"<{part}>{b}</{part}>" for b in body[1:])
            parts = [f"<ul class=c1>{menu}</ul>", f"<div class=c2>{draw.choice(notice)}</div>", f"<{box} class=c3>{inner}</{box}>", f"<div class=c4>{low}</div>"]
            if draw.random() < 0.3:
                parts.insert(2, f"<div class=c5>Join site {host} today</div>")
            if box == "td":
                parts = ["<table><tr><td>" + parts[0] + "</td></tr>", *[f"<tr>{p if p.startswith('<td') else f'<td>{p}</td>'}</tr>" for p in parts[1:]], "</table>"]
            yield f"http://s{host}.example/{k}", "<html><body>" + "".join(parts) + "</body></html>", "\n".join(body)


def test_wrapper_decides_on_sites_without_telling_names(spark):
    made = list(sites(random.Random(12)))
    got = extracted(spark, [m[:2] for m in made], least=2)
    assert got == [m[2] for m in made]
    assert all(whole(m[1]) != m[2] for m in made)  # the parser alone leaves the template in
