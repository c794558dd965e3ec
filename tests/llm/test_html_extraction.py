import html
import json
import random
import re

from messy import rows_of
from pyspark.sql import functions as F

from ascentframe.llm import html_extraction as H
from ascentframe.llm import page_tree as T
from ascentframe.llm.common import table

PAGES = "page_id long, url string, html string, host string, text string"


def page(k, article, extra=""):
    return f"<html><body><div class='banner notice'>Cookies</div><header><h2>Site</h2></header><nav><a>m{k}</a></nav>{article}<aside>side {k}</aside>{extra}<footer>f {k}</footer></body></html>"


def extracted(spark, rows):
    return rows_of(H.extract(spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows], PAGES)), "page_id", "url", "text", "n_chars")


def test_messy_pages(spark):
    u = "http://h.example/x"
    rows = [
        (1, u, page(1, "<article class='post'><header><h1>T &amp; U</h1></header><p>a <b>b</b>c<p>d&nbsp;e<br>f<ul><li>g<li>h</ul><form>no</form><script>var x='<p>'</script></article>")),
        (2, u, page(2, "<article class='post'><h1>V</h1><p>w &lt;p&gt; &am &copy x</p><div class='share social'>s</div></article>", "<section id='comments'><article class='comment'>" + "c " * 500 + "</article></section>")),
        (2, u, page(2, "<article class='post'><h1>V</h1><p>w &lt;p&gt; &am &copy x</p><div class='share social'>s</div></article>")),
        (3, u, None), (4, u, ""), (5, None, "plain  text"), (6, "no host", "<p>one<p>two</p></b></div>"), (None, u, "<article>x</article"),
        (7, "http://main.example", "<main><p>m1</p><article></article></main><div>other</div>"),
        (8, "http://div.example", "<body><div class=top><p>t</p></div><div class=mid><p>" + "word " * 30_000 + "</p><p>end</p></div></body>"),
        (9, "http://deep.example", "<div>" * 5000 + "deep" + "</div>" * 20),
        (10, "http://h.example/", "<!-- <article>no</article> --><style>p{}</style><article class=post>yes<textarea>no</textarea></article>"),
    ]
    got = {(r[0], i): r for i, r in enumerate(extracted(spark, rows))}
    texts = {}
    for (k, _), r in got.items():
        texts.setdefault(k, []).append(r[2])
        assert r[3] == len(r[2])
    assert texts[1] == ["T & U a bc d e f g h"]
    assert texts[2] == ["V w <p> &am © x"] * 2
    assert texts[3] == texts[4] == [""]
    assert texts[5] == ["plain text"] and texts[6] == ["one two"] and texts[None] == ["x"]
    assert texts[7] == ["m1"] and texts[9] == ["deep"] and texts[10] == ["yes"]
    assert texts[8] == ["word " * 30_000 + "end"]
    assert extracted(spark, []) == []


def test_constant_nodes_are_template_only_where_pages_differ(spark):
    body = "<article><p>text {0}</p><div class=box>Read our terms</div></article>"
    differ = [(k, "http://a.example/x", page(k, body.format(k))) for k in range(6)]
    copies = [(k, "http://b.example/x", page(0, body.format(0))) for k in range(10, 16)]
    few = [(k, "http://c.example/x", page(k, body.format(k))) for k in range(20, 23)]
    texts = {r[0]: r[2] for r in extracted(spark, differ + copies + few)}
    assert texts[3] == "text 3" and texts[12] == "text 0 Read our terms" and texts[21] == "text 21 Read our terms"


def test_copies_beside_another_page_keep_their_text(spark):
    copied = "<article><h2>Head</h2><p>own <em>words</em></p><ul><li>one<li>two</ul><blockquote>said</blockquote></article>"
    rows = [(k, "http://a.example/x", page(k, copied)) for k in range(6)] + [(9, "http://a.example/y", page(9, "<article><p>other</p></article>"))]
    texts = {r[0]: r[2] for r in extracted(spark, rows)}
    assert [texts[k] for k in range(6)] == ["Head own words one two said"] * 6 and texts[9] == "other"


def test_repeated_subheading_is_content(spark):
    head = "<article><p>text {0} <b>Note</b> more {0}</p><h2>Summary</h2><p>end {0}</p></article>"
    rows = [(k, "http://a.example/x", page(k, head.format(k))) for k in range(5)]
    rows += [(k, "http://a.example/x", page(k, f"<article><p>text {k}</p></article>")) for k in range(5, 20)]
    texts = {r[0]: r[2] for r in extracted(spark, rows)}
    assert texts[3] == "text 3 Note more 3 Summary end 3" and texts[7] == "text 7"


def test_tree_matching():
    def shape(text):
        return T.rebuilt(text)

    assert T.matching(shape("a(b,c(d,e),f)"), shape("a(c(e),f,b)"), {}) == 4
    joined = T.align(shape("a(b,c(d),f)"), shape("a(x,b,c(e),g)"))
    assert T.written(joined) in ("a(x,b,c(d,e),f,g)", "a(x,b,c(e,d),g,f)", "a(x,b,c(d,e),g,f)", "a(x,b,c(e,d),f,g)")
    assert joined.pages == 2 and [c.pages for c in joined.children if c.key == "b"] == [2]
    assert T.written(T.rebuilt(T.written(joined))) == T.written(joined)
    # siblings of one key stay apart and are matched by what is in them
    joined = T.align(shape("a(d(x),d(y),d(z))"), shape("a(d(y),d(z))"))
    assert T.written(joined) == "a(d(x),d(y),d(z))" and [c.pages for c in joined.children] == [1, 2, 2]
    wrapper, page = shape("a(d(x),d(y),e)"), shape("a(d(y),q)")
    of = T.mapped(wrapper, page)
    assert of[id(page.children[0])] is wrapper.children[1] and id(page.children[1]) not in of
    long = T._from_the_front([T.Shape(k) for k in "abcab"], [T.Shape(k) for k in "bxaab"])
    assert [(x and x.key, y and y.key) for x, y in long] == [("a", None), ("b", "b"), ("c", None), (None, "x"), ("a", "a"), (None, "a"), ("b", "b")] or sum(1 for x, y in long if x and y) >= 2


def test_long_lists_are_matched_whole(monkeypatch):
    """Lists over CELLS were matched from the front, which lost what comes after an early stray match."""
    words = [T.rebuilt(f"k{n}(x)") for n in range(200)]
    pairs = T._beside([T.Shape("far"), *words], [*(T.rebuilt(f"k{n}(x)") for n in range(200)), T.Shape("far")])
    assert sum(1 for x, y in pairs if x and y) == 200 and len(pairs) == 202
    a, b = T.Shape("a"), T.Shape("a")
    a.children, b.children = [T.Shape("far"), *words], [*words, T.Shape("far")]
    assert T.matching(a, b, {}) == 401

    def some(seed, most):
        pick = random.Random(seed)
        return [T.rebuilt(pick.choice(["a", "b", "c(x)", "c(y,x)", "c(x,y,z)", "d(c(x),c(y))", "d(c(y))"])) for _ in range(pick.randint(0, most))]

    lists = [(some(seed, 12), some(seed + 1000, 12)) for seed in range(150)]
    whole = [T._beside(*both) for both in lists]
    monkeypatch.setattr(T, "CELLS", 0)
    for limit in (1 << 22, 0):
        monkeypatch.setattr(T, "WEIGHTS", limit)
        assert all(T._beside(*both) == was for both, was in zip(lists, whole))


def test_collapsed_trees():
    def tree(html):
        return T.written(T.collapse(T.parse(html)))

    assert tree("<body><div>a</div><div><h1>b</h1><p>c<p>d<ul><li>e</ul></div><div>f</div></body>") == "#page(body(div,div(#flow),div))"
    assert tree("<a><div>x</div></a><p>y</p><section><p>z</p></section><p>w</p>") == "#page(div,#flow,section(#flow),#flow)"
    assert tree("<div><p>x</p></div>" * 7) == "#page(" + ",".join(["div(#flow)"] * 7) + ")" and tree("<div><p>x</p></div>" * 500) == "#page(div(#flow))"


def by_hand(htmls):
    """Texts of one host's pages by the plain functions: without and with its wrapper."""
    joined = H._joined(T.collapse(T.parse(x)) for x in htmls)
    slot = H.slot_of(joined, any(n.varies and n.chars for n in joined.walk()))
    marked = lambda n: [n.key, id(n) in slot, [marked(c) for c in n.children]]
    wrapper = H.Wrapper(json.dumps({"tree": marked(joined), "fixed": []}))
    return [H.text_of(x, None) for x in htmls], [H.text_of(x, wrapper) for x in htmls]


def test_wrapper_decides_without_any_list(monkeypatch):
    for name in ("SKIPPED_TAGS", "SKIPPED_WORDS", "CONTENT_WORDS"):
        monkeypatch.setattr(H, name, frozenset())
    page = "<body><div>Home Start About Imprint Contact and more</div><div>date {0} clock</div><div><h1>Title {0}</h1><p>story {0} goes on {0}</p></div><div>All rights reserved {1}</div></body>"
    alone, wrapped = by_hand([page.format(k, "Terms " * 40) for k in range(4)])
    assert wrapped == [f"Title {k} story {k} goes on {k}" for k in range(4)]
    assert all("Terms" in x for x in alone)  # a page alone cannot know


def test_names_do_not_cut_what_varies(spark):
    story = "<article><p class='text-main related'>Story {0}</p><section class='story-comment'>Said {0}</section></article><div class='reader-remarks'>{1}</div>"
    rows = [(k, "http://a.example/x", page(k, story.format(k, f"remark {k}"))) for k in range(6)]
    few = "<body><div class=own>real {0}</div><div class=other>" + "Terms of use " * 30 + "</div></body>"
    rows += [(k, "http://four.example/x", few.format(k)) for k in range(10, 14)]
    side = "<body><div>Menu</div><div>date {0} clock</div><div><p>text {0} and more text {0}</p></div></body>"
    rows += [(k, "http://side.example/x", side.format(k)) for k in range(20, 26)]
    texts = {r[0]: r[2] for r in extracted(spark, rows)}
    assert [texts[k] for k in range(6)] == [f"Story {k} Said {k}" for k in range(6)]
    assert [texts[k] for k in range(10, 14)] == [f"real {k}" for k in range(10, 14)]
    assert [texts[k] for k in range(20, 26)] == [f"text {k} and more text {k}" for k in range(20, 26)]


def test_many_shapes_of_a_host_are_joined_in_rounds(spark, monkeypatch):
    """Every page has a tree of its own; the slot stands at another place on each."""
    monkeypatch.setattr(H, "FOLD", 4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = []
    for k in range(90):
        extra = "".join(f"<div class='{words[(k >> j) % 6]}{'x' * (k % 7)}'>bit</div>" for j in range(k % 5))
        rows.append((k, "http://a.example/x", f"<body>{extra}<div class=core><p>text {k} of the page</p></div><div>end</div></body>"))
    texts = {r[0]: r[2] for r in extracted(spark, rows)}
    assert [texts[k] for k in range(90)] == [f"text {k} of the page" for k in range(90)]


def test_rare_nodes_of_a_joined_tree_go_first():
    trees = [T.rebuilt(f"a(b,c.{'x' * k},d)") for k in range(1, 60)]
    tree = H._joined(iter(trees))
    assert sum(1 for _ in tree.walk()) == 62
    assert T.written(H.thinned(tree, 10)) == "a(b,d)"


def test_a_joined_tree_keeps_all_nodes():
    trees = [T.rebuilt(f"a(b(c.x{k}),d)") for k in range(5000)]
    assert sum(1 for _ in H._joined(iter(trees)).walk()) == 5003


def test_text_under_ever_new_names(spark):
    """2,500 pages of a host, each with names of its own around its text and beside it (letters only, as keys are)."""
    letters = ["".join("abcdefghij"[int(d)] for d in str(k)) for k in range(2500)]
    body = "<body><div class='box q{0}'><p>text {1} and more text {1}</p></div><div class='foot r{0}'>Terms of use</div><u-{0}>x</u-{0}></body>"
    own = [(k, "http://a.example/x", body.format(w, k)) for k, w in enumerate(letters)]
    texts = {r[0]: r[2] for r in extracted(spark, own)}
    assert [texts[k] for k in range(2500)] == [f"text {k} and more text {k}" for k in range(2500)]
    frame = spark.createDataFrame([("h", h) for _, _, h in own], "host string, html string")
    assert H.common(frame).first().names == '["box","foot"]'
    assert len(H.induce(frame, F.col("host")).first().wrapper) < 1000


def test_given_pages(spark):
    frame = table(spark, "/root/testdata/sf0.01", "pages")
    texts = {r[0]: r[1] for r in rows_of(H.extract(frame), "page_id", "text")}
    for r in frame.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inner)
        assert texts[r.page_id] == " ".join(html.unescape(plain).split())


def test_constant_siblings_without_class_names(spark):
    divs = "<body><div>Home <a href=/>Start</a></div><div><h1>Title {0}</h1><p>text {0}</p><p>Read our terms</p><p>more {0}</p></div><div>All rights reserved</div></body>"
    cells = "<table><tr><td>Home | About</td></tr><tr><td>left menu</td><td><p>text {0}</p><p>more {0}</p></td></tr><tr><td>Imprint</td></tr></table>"
    rows = [(k, "http://div.example/x", divs.format(k)) for k in range(6)] + [(k, "http://td.example/x", cells.format(k)) for k in range(10, 16)]
    rows += [(k, "http://long.example/x", f"<body><div>Menu</div><div>{'words ' * k}</div><div>{'Terms ' * 200}</div></body>") for k in range(20, 26)]
    texts = {r[0]: r[2] for r in extracted(spark, rows)}
    assert [texts[k] for k in range(6)] == [f"Title {k} text {k} more {k}" for k in range(6)]
    assert [texts[k] for k in range(10, 16)] == [f"text {k} more {k}" for k in range(10, 16)]
    assert texts[22] == ("words " * 22).strip()


def test_long_template_is_not_the_content_slot(spark):
    """The template outweighs the article, in siblings of one key and of different keys."""
    pages = "<body><div><section><p>{0}</p></section></div><div><p>text {1}</p><p>end {1}</p></div></body>"
    rows = [(k, "http://one.example/x", pages.format("Terms " * 100, k)) for k in range(6)]
    pages = "<body><div class=a><p>{0}</p></div><div class=b><p>text {1}</p><p>end {1}</p></div></body>"
    rows += [(k, "http://two.example/x", pages.format("Terms " * 100, k)) for k in range(10, 16)]
    texts = {r[0]: r[2] for r in extracted(spark, rows)}
    assert [texts[k] for k in range(6)] == [f"text {k} end {k}" for k in range(6)]
    assert [texts[k] for k in range(10, 16)] == [f"text {k} end {k}" for k in range(10, 16)]
