"""Pages whose menus carry no marks, pages that broke the reader, and awkward tables."""

import html
import math
import re
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strokelab.llm import html_text
from strokelab.llm.common import table

PAGES = "page_id long, url string, html string"


def article_of(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", body)]
    return "\n".join(b for b in blocks if b)


def test_tree_alone_cleans_the_given_pages_without_their_marks(spark, small):
    """The given pages, one menu, advert and footer a host, with every mark of their role taken out."""
    part = re.compile(r"(?s)<nav>.*?</nav>|<div class=\"ad\">.*?</div>|<footer>.*?</footer>")
    first, rows, want = {}, [], {}
    for p in table(spark, small.replace("sf0.001", "sf0.1"), "pages").orderBy("page_id").collect():
        host = re.search(r"://([^/?#]*)", p["url"])[1].lower()
        parts = first.setdefault(host, parts_of(part, p["html"]))
        text = part.sub(lambda m, parts=dict(parts): parts[m[0][:4]], p["html"])
        for tag in ("nav", "footer", "article"):
            text = text.replace(f"<{tag}>", f"<div class={tag[::-1]}>").replace(f"</{tag}>", "</div>")
        rows.append((p["page_id"], p["url"], text.replace('class="ad"', "class=x")))
        want[p["page_id"]] = article_of(p["html"])
    pages = spark.createDataFrame(rows, PAGES)
    many = {h for h, n in Counter(re.search(r"://([^/?#]*)", r[1])[1].lower() for r in rows).items() if n > 2}
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages, declared=False).collect()}
    asked = [r[0] for r in rows if re.search(r"://([^/?#]*)", r[1])[1].lower() in many]
    assert len(asked) > 50 and all(got[i] == want[i] for i in asked)


def parts_of(part, page):
    return {m[0][:4]: m[0] for m in part.finditer(page)}


def test_importance_by_hand(spark):
    page = "<html><body><div class=top><p>Welcome</p></div><div class=body>{}</div></body></html>"
    bodies = ["<p>a</p>", "<p>b</p><h2>c</h2>", "<p>b</p>", "<p>d</p><ul><li>e</ul>"]
    pages = spark.createDataFrame([(i, "http://h/", page.format(b)) for i, b in enumerate([*bodies, bodies[0]])], PAGES)
    got = {r["path"]: r for r in html_text.style_tree(pages).collect()}
    assert got["/html"]["pages"] == 4  # the fifth page equals the first
    assert math.isclose(got["/html/body/div.top/p"]["importance"], 0, abs_tol=1e-12) and got["/html/body/div.top"]["best"] < 0.01
    ln = math.log
    same = 2 * ln(2) / ln(4)  # "b" stands on two pages
    assert math.isclose(got["/html/body/div.body/p"]["importance"], 1 - same / 4)
    shapes = 1 - 2 / 4 * ln(2) / ln(4)  # p twice, p>h2, p>ul
    fade = 0.9**3
    assert math.isclose(got["/html/body/div.body"]["importance"], (1 - fade) * shapes + fade * (1 - same / 6))
    assert got["/html/body/div.body"]["best"] >= got["/html/body/div.body/p"]["importance"]


def test_text_is_not_lost():
    text = html_text.main_text
    assert text("<article><p title=don't>Hello world</p><p>More</p></article>") == "Hello world\nMore"
    assert text("<article><svg><p>a</p><p>Body</p></article>") == "a\nBody"
    assert text("<article><noscript><p>Body</p><p title=\"open>end</p></article>") == "Body\nend"
    assert text("<article><h2 id=related-work>R</h2><section class='related-work'><p>x</p></section><section id=discussion>d</section><div class='side-effects' id=search-trees>t</div><math>y</math></article>") == "R\nx\nd\nt\ny"
    assert text("<article><p>a<div class=comment-list><p>c</div><div id='ad-7'>b</div><p class='newsletter signup'>n<p>z <span class=share>s</span> y</article>") == "a\nz y"
    assert text("<p>one<script>two</p>") == "one" and text("<p>x</p><p>a &lt;b&gt; &amp;amp; c") == "x\na <b> &amp; c"


def test_awkward_pages(spark):
    words = " ".join(f"word{i}" for i in range(200_000))
    rows = [(1, None, None), (1, None, None), (2, "http://a/1", f"<nav>m</nav><p>{words}"), (3, "http://a/1", ""), (None, "no host", "<p>x"), (4, "http://a/2", "<p>y"), (4, "http://a/2", "<p>y")]
    pages = spark.createDataFrame(rows, PAGES).select("*", *[F.lit(1).alias(c) for c in ("text", "n_chars", "host", "path", "low", "_host", "page", "features", "best")])
    got = defaultdict(list)
    for r in html_text.extract(pages).collect():
        assert r["n_chars"] == len(r["text"])
        got[r["page_id"]].append(r["text"])
    assert got == {1: ["", ""], 2: [words], 3: [""], None: ["x"], 4: ["y", "y"]}


def test_reader_comments_and_headers_go():
    text = html_text.main_text
    assert text("<article><p>p</p><article class='comment'><p>c</p></article></article>") == "p"
    assert text("<main><article class='post'><p>p</p></article><article class='comment-item even'><p>c</p></article><article itemprop=comment><p>d</p></article></main>") == "p"
    assert text("<article class='news sponsors-story'><p>p</p></article><article class='comment'>c</article>") == "p"
    assert text("<article><p>p<ol class=commentlist><li>c</ol><ol class=steps><li>s</ol><div role=comment>r</div></article>") == "p\ns"
    assert text("<article><section class=banner>b</section><div class=header>h</div><div class='site-header'>h</div><div class='post-header'><h1>t</h1></div><header><p>by</header>p</article>") == "t\nby\np"
    assert text("<div class='page-header'>h</div><p class=header>q</p><h2 class=header>t</h2><p>p</p>") == "t\np"


def test_references_are_decoded_in_each_text_node():
    text = html_text.main_text
    assert text("<p>a&<b>amp;</b>x &amp;lt; y&#38;<i>lt;</i></p>") == "a&amp;x &lt; y&lt;"
    assert text("<p>a&nbsp;&#9; b<![CDATA[ &amp; ]]>c</p>") == "a b &amp; c"


def test_deep_pages():
    deep = "<div class=a>" * 200_000 + "x" + "</span>" * 200_000 + "<p>y</p>"
    begin = time.process_time()
    assert html_text.main_text(deep) == "x\ny"
    _, seen = html_text.page_features("<b>" * 50_000 + "<p>u</p>" * 50_000 + deep)
    assert time.process_time() - begin < 30
    assert max(path.count("/") for path, _, _ in seen) == html_text.DEEPEST
