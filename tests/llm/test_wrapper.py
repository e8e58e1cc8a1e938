import itertools
import random
import re

import pytest

from shoploom.llm import wrapper
from shoploom.llm.queries import queries
from shoploom.llm.wrapper import align, from_skeleton, main_text, parse, skeleton

FOLDER = "/root/testdata/sf0.01"

PAGES = [
    ("", ""),
    ("plain &amp; text", "plain & text"),
    ("<p>a<p>b<b>c</b>d<br>e", "a bcd e"),
    ("<nav>menu</nav><header>head</header><p>x  y\n z</p><footer>f</footer><aside>s</aside><form>q</form>", "x y z"),
    ("<script>var t='</p>'; if (a<b) {}</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<article><h1>T</h1><p>one</p><div class='ad-slot'>buy</div><section id=comments>me too</section></article><p>other</p>", "T one"),
    ("<div class=\"cookie-notice\">c</div><div role=navigation>n</div><div hidden>h</div><div class='reading'>r</div>", "r"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
    ("<p>1 < 2 &lt;b&gt; &#233; &nbsp; x</p", "1 < 2 <b> é x"),
    ("<p>a<span class=ad>b<b>c</span>d</p>", "a d"),
    ("<title>t</title><p>cut <b>off", "cut off"),
    ("<div>" * 5000 + "deep" + "</div>" * 10, "deep"),
    ("<p>" + "w " * 100_000 + "</p>", ("w " * 100_000).strip()),
    ("<p title='a>b' data-x=\"<p>\">q</p><img alt='>'>r", "q r"),
    ("<textarea><p>no</p></textarea><select><option>no<option>no</select><button>no</button>yes", "yes"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert main_text(parse(page)) == text


def plain_matching(a, b):
    """Simple tree matching as it is defined."""
    if (a.tag, a.beside) != (b.tag, b.beside):
        return 0
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain_matching(x, y))
    return best[-1][-1] + 1


def random_page(rng, depth=3):
    tags = ("div", "p", "ul", "section")
    return "".join(f"<{(t := rng.choice(tags))}>{random_page(rng, depth - 1) if depth else 'x'}</{t}>" for _ in range(rng.randint(0, 4)))


def test_alignment_against_plain_matching():
    rng = random.Random(6)
    for _ in range(200):
        a, b = parse(random_page(rng)), parse(random_page(rng))
        pairs = align(a, b)
        assert len(pairs) + 1 == plain_matching(a, b)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert all(x.tag == y.tag for x, y in pairs)


def test_skeleton_round_trip():
    root = parse(PAGES[5][0])
    again = from_skeleton(skeleton(root))
    assert again.shape == root.shape and skeleton(again).count(b"\n") == skeleton(root).count(b"\n")


def test_constant_nodes_are_template(spark):
    page = "<div>Welcome to our site</div><div><h2>{k}</h2><p>story {k} here</p></div><div>All rights reserved</div>"
    rows = [(k, f"http://x.net/{k}", page.format(k=k)) for k in range(8)] + [(100 + k, "http://one.net/", page.format(k=1)) for k in range(9)]
    rows += [(200, None, None), (201, None, ""), (202, "http://two.net/", page.format(k=2))]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, text string").repartition(4)
    found = {r.page_id: r for r in wrapper.extracted(pages).collect()}
    assert len(found) == len(rows)
    assert all(found[k].text == f"{k} story {k} here" for k in range(8))
    assert all(found[k].text == "Welcome to our site 1 story 1 here All rights reserved" for k in range(100, 109))
    assert found[200].text == found[201].text == "" and found[202].n_chars == len(found[202].text) > 20


def test_chunks_of_a_large_host_agree(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "CHUNK", 4)
    page = "<div>Same on all</div><p>story {k} here</p>"
    pages = spark.createDataFrame([(f"http://x.net/{k}", page.format(k=k)) for k in range(60)], "url string, html string")
    assert {r.text for r in wrapper.extracted(pages).collect()} == {f"story {k} here" for k in range(60)}


def test_empty(spark):
    assert wrapper.extracted(spark.createDataFrame([], "url string, html string")).count() == 0


def test_query_keeps_the_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = queries()["op9_html_extraction"](spark, FOLDER).collect()
    assert len(found) == len(pages)
    import html

    for r in found:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        plain = " ".join(html.unescape(re.sub(r"</?(?:b)>", "", re.sub(r"<(?:p|/p|br|h1|/h1)>", " ", article))).split())
        assert r.text == plain and r.n_chars == len(plain)


def extracted_texts(spark, htmls):
    """The texts by row number of the pages of one host."""
    rows = [(k, f"http://x.net/{k}", page) for k, page in enumerate(htmls)]
    return {r.k: r.text for r in wrapper.extracted(spark.createDataFrame(rows, "k long, url string, html string")).collect()}


def test_odd_pages_leave_the_template(spark):
    page = "<div>Our menu</div><div><h2>{k}</h2><p>story {k} here</p></div><div>All rights reserved</div>"
    found = extracted_texts(spark, [*(page.format(k=k) for k in range(40)), "", None, "bare text", "<div>few</div>"])
    assert [found[k] for k in range(40)] == [f"{k} story {k} here" for k in range(40)]
    assert [found[k] for k in range(40, 44)] == ["", "", "bare text", "few"]


def test_texts_missing_from_the_first_page_have_slots():
    trees = [from_skeleton(skeleton(parse(x))) for x in ("<div>a</div><p>1</p>", "<div>a</div><p>2</p>", "<div>a</div><ul><li>m</ul><p>3</p>", "<ul><li>m</ul><p>4</p>")]
    first, second, third, fourth = ([slot for slot, _, _ in texts] for texts in wrapper.slots(trees))
    assert first == second == [third[0], third[2]] and fourth == third[1:] and len(set(third)) == 3


AROUND = [
    ("<div class='page has-sidebar'><article>story</article></div>", "story"),
    ("<div class='page has-sidebar'><p>story</p></div>", "story"),
    ("<div id='content-widget'><p>story</p></div>", "story"),
    ("<section id='share-price'><p>story</p></section>", "story"),
    ("<form id=aspnetForm><div class=menu>m</div><article>story</article></form>", "story"),
    ("<form id=aspnetForm><nav>m</nav><div><p>a story</p></div><form class=newsletter>q</form></form>", "a story"),
    ("<p>home</p><div class=widget><article>story</article></div>", "story"),
    ("<div class=sidebar><p>story</p><div class=widget>w</div></div>", "story"),
    ("<div class=ad><main>story</main></div>", "story"),
    ("<div class=related><article>story</article></div>", "story"),
    ("<p>story</p><div class=comments><article>me too</article></div>", "story"),
    ("<article>story</article><aside><article>other</article></aside>", "story"),
    ("<form><article>story<div class=related><article>other</article></div></article></form>", "story"),
    ("<div hidden><main>no</main></div><nav>no</nav>", ""),
    ("<p>story</p><div class='menu-wrapper'>m</div><div class='top ad-300x250'>b</div><div id=sidebar-left>s</div><form>q</form>", "story"),
]


@pytest.mark.parametrize("page, text", AROUND)
def test_names_around_the_main_text(page, text):
    assert main_text(parse(page)) == text


@pytest.mark.parametrize("depth", [300, 20_000])
def test_deep_nests_close_in_their_order(depth):
    nest = lambda inside: "<div>" * depth + inside + "</div>" * depth
    page = "<nav>m</nav><div><article>one " + nest("two <nav>x</nav><div class=ad>y</div>") + " three</article></div><p>other</p>"
    assert main_text(parse(page)) == "one two three"
    assert main_text(parse("<div>" * depth + "<nav>x</nav>a</section></p>" * 10)) == " ".join("a" * 10)


def test_deep_trees_align(spark):
    trees = [parse("<div>" * 3000 + f"<p>{k}</p>" * k) for k in (1, 2)]
    assert len(align(*trees)) == 3002


def test_templates_of_several_layouts(spark):
    notices = ["Buy the new phone", "Fly to the sun", "Read our mail"]
    article = "<div>Our menu</div><div>{ad}</div><div><h2>{k}</h2><p>story {k} here</p></div><div>All rights reserved</div>"
    listing = "<div>Unser Katalog</div><ul><li>ware {k}</li><li>preis {k}</li></ul><div>Impressum</div>"
    no_menu = "<div>{ad}</div><div><h2>{k}</h2><p>story {k} here</p></div><div>All rights reserved</div>"
    layouts = [article, article, listing, article, listing, no_menu, article, listing]
    found = extracted_texts(spark, [layouts[k % 8].format(k=k, ad=notices[k % 3]) for k in range(64)])
    assert all(found[k] == (f"ware {k} preis {k}" if layouts[k % 8] is listing else f"{k} story {k} here") for k in range(64))


def test_repeated_content_is_no_template(spark):
    body = lambda k: f"<p>the long first paragraph of story {k}</p><p>and its end {k}</p>"
    copies = [f"<div>Our menu</div><div>visit {k}</div>{body(k % 8)}" for k in range(64)]
    assert all(text.endswith(f"the long first paragraph of story {k % 8} and its end {k % 8}") for k, text in extracted_texts(spark, copies).items())
    odd = [f"<div>Our menu</div><p>line {k}</p><p>{'Thank you' if k % 8 == 0 else f'word {k}'}</p>" for k in range(64)]
    assert all(text == f"line {k} " + ("Thank you" if k % 8 == 0 else f"word {k}") for k, text in extracted_texts(spark, odd).items())


def test_articles_keep_their_subheads(spark):
    page = "<div>Our menu</div><article><h3>Ingredients</h3><p>{k} apples</p><h3>Method</h3><p>stir {k} times</p></article><div>All rights reserved</div>"
    found = extracted_texts(spark, [page.format(k=k) for k in range(12)])
    assert all(found[k] == f"Ingredients {k} apples Method stir {k} times" for k in range(12))


def bare(page):
    """A page without any cue of tag, class or role: what is left is for the wrapper to tell."""
    page = re.sub(r"(?is)<(script|style|noscript|template)\b.*?</\1>|<head\b.*?</head>", "", page)
    page = re.sub(r"(?i)<(/?)(?:article|main|nav|header|footer|aside|section|form|figure|button|label)\b[^>]*>", r"<\1div>", page)
    return re.sub(r"(?i)<(div|p|ul|li|span|h\d|a)\b[^>]*>", r"<\1>", page)


def test_the_wrapper_alone(spark):
    """With no cues, no page loses any of its article; where hosts have menus that repeat, those are what goes.

    The table's own menus and notices differ from page to page, so that no wrapper can tell them from content.
    """
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html").toPandas()
    host = pages.url.str.extract(r"://([^/?#]*)", expand=False).fillna("")
    article = pages.html.str.extract(r"(?s)<article>(.*?)</article>", expand=False)
    cued = [main_text(parse(x)) for x in pages.html]

    def alone(htmls):
        found = wrapper.extracted(spark.createDataFrame(pages.assign(html=htmls)))
        texts = {r.page_id: r.text for r in found.collect()}
        return [texts[k] for k in pages.page_id]

    assert all(c in t for t, c in zip(alone([bare(x) for x in pages.html]), cued, strict=True))
    menu = "<div><ul><li>Home of {0}</li><li>News of {0}</li></ul></div><div><p>Read {0} daily</p></div><div>{1}</div><div>All rights with {0}</div>"
    texts = alone([menu.format(h, bare(a)) for h, a in zip(host, article, strict=True)])
    large = host.map(host.value_counts()) >= 2 * wrapper.LEAST_PAGES
    right = [t == c for t, c, some in zip(texts, cued, large, strict=True) if some]
    assert len(right) > 50 and sum(right) / len(right) >= 0.95
    assert all(c in t for t, c in zip(texts, cued, strict=True))
