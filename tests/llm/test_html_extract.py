import random
import re
import time

import numpy as np
import pytest

from marketloom.llm import html_extract as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body><nav><ul>%s</ul></nav>
<div class="ad">Buy now.</div><article><h1>%s</h1><p><b>%s<br><p>%s &amp; caf&eacute; &#x263A;</p><p>%s</p></article><footer>&copy; site</footer></body></html>"""


def say(rng, n):
    return (" ".join(rng.choice("stone river maple quiet engine window garden silver morning letter".split()) for _ in range(n)) + ".").capitalize()


def made(n=60, seed=1):
    rng, out = random.Random(seed), []
    for i in range(n):
        parts = [say(rng, 4), say(rng, 30), say(rng, 40), say(rng, rng.randint(1, 60))]
        links = "".join(f'<li><a href="/{k}">{say(rng, 2)}</a></li>' for k in range(6))
        out.append((i, f"http://x/{i}", PAGE % (links, *parts), " ".join([parts[0], parts[1], parts[2], "& café ☺", parts[3]])))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return h.train(spark.createDataFrame([r[:3] for r in made()], "page_id long, url string, html string"))


def test_held_out_pages(model):
    rows = made(60, seed=2)
    assert np.mean([a == r[3] for a, r in zip(h.extract_all([r[2] for r in rows], model), rows)]) > 0.95


def test_other_page_plans(model):
    rng, right = random.Random(5), []
    for _, _, source, _ in made(60, seed=3):
        s = h.altered(source, rng)
        page = h.Page(s)
        labels = h.page_labels(page)
        if labels is not None:
            want, got = page.text(labels > 0).split(), h.extract(s, model).split()
            both = sum((__import__("collections").Counter(want) & __import__("collections").Counter(got)).values())
            right.append(2 * both / (len(want) + len(got)))
    assert np.mean(right) > 0.95


def test_decoding_is_best_and_free_of_contradictions():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(2, 10))
        parents = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        odds, own = rng.normal(size=n), rng.integers(0, 50, n).astype(float)
        kept = h.decode(odds, own, parents)
        value = odds * (0.05 + np.sqrt(own))
        assert all(kept[parents[i]] for i in range(1, n) if kept[i])
        best = max(sum(value[i] for i in range(1, n) if s >> i & 1) for s in range(1, 2**n, 2) if all(s >> parents[i] & 1 for i in range(1, n) if s >> i & 1))
        assert np.isclose(sum(value[1:][kept[1:]]), best)


def test_parsing():
    text = lambda s: h.Page(s).text(np.ones(len(h.Page(s).tags), bool))
    assert text("<p>a<b>b</b>c<br>d<p>e  \n f</p>g") == "abc d e f g"
    assert text("<p>x<!-- no --><script>if (a<b) '</p>'</script>y</p><style>z</style>") == "xy"
    assert text("<ul><li>a<li>b</ul>&lt;p&gt; &am &amp") == "a b <p> &am &"
    assert text('<a title="a>b">q</a><img src=x>r') == "qr"
    assert text("<div>cut off <p>here <b") == "cut off here <b"
    page = h.Page("<div><p>a<div>b</div></p></div>")
    assert page.tags == ["html", "div", "p", "div"] and page.parents == [-1, 0, 1, 1]


def test_only_raw_elements_are_skipped():
    text = lambda s: h.Page(s).text(np.ones(len(h.Page(s).tags), bool))
    assert text("<p>a<noscript>b</noscript><object>c</object><textarea>d</textarea><svg><text>e</text></svg><math><mi>f</mi></math></p>g") == "a b c d e f g"
    for tag in "select object svg iframe noscript template".split():
        assert text(f"<p>a</p><{tag}><p>rest of the page</p>") == "a rest of the page"
    assert text("\u0130" * 9 + "<script>no</script>after it <STYLE>no</Style >end") == "\u0130" * 9 + "after it end"
    assert text("<script>a</scripts>b</script>c") == "c"
    assert text("<head><title>t</title><body><header>h</header>b") == "h b"


NOTICES = ['<span class="cookie-notice">We use cookies.</span>', '<a href="/">Home</a>', "<button>Subscribe now</button>", "Skip to the text", '<label>Your name</label>', '<a class="login" href="/l">Log in</a><a href="/b">Blog</a>', '<span class="promo">Only today</span>', "<span>All rights reserved</span>"]


def test_inline_boilerplate_around_and_in_the_text(model):
    """Whole pages with notices, buttons and links outside blocks, and buttons and share links inside the text."""
    rng, right = random.Random(8), []
    for _, _, source, want in made(80, seed=4):
        for spot, after in (("<body>", True), ("<article>", False), ("</article>", True), ("<footer>", False)):
            i = source.find(spot) + (len(spot) if after else 0)
            source = source[:i] + "".join(rng.sample(NOTICES, rng.randint(0, 2))) + source[i:]
        for x in ("<button>Subscribe now</button>", '<a class="share" href="/s">Share this</a>', '<span class="ad">Buy</span>'):
            i = source.rfind("</p>")
            source = source[:i] + (x if rng.random() < 0.5 else "") + source[i:]
        right.append(h.extract(source, model) == want)
    assert np.mean(right) > 0.95


def test_the_pages_of_the_verdict(model):
    article = "<article><h1>Title here</h1><p>The stone river. It is quiet, and the engine of the garden is silver.</p><p>A letter in the morning, by the window. Maple and stone.</p></article>"
    want = h.Page(article).text(np.ones(20, bool))
    page = f'<body><span class="cookie-notice">We use cookies.</span><a href="/">Home</a>{article}</body>'
    assert h.extract(page, model) == want
    assert h.extract(page.replace("silver.</p>", "silver.<button>Subscribe now</button></p>"), model) == want


def test_inline_nodes():
    page = h.Page('<body>bare <i>x</i><div>a <b>b</b> <p>c<a href="/">d</a><span class="share">e</span>f<button>g</button></p></div>')
    assert page.tags == ["html", "#text", "i", "div", "b", "p", "span", "button"]
    kept = np.array([t not in ("span", "button", "#text") for t in page.tags])
    assert page.text(kept) == "x a b cdf"


def test_unclosed_markup_takes_linear_time():
    for markup in ("<b>", "<b><p>", "<a>x", "<div><b></i>", "<p><b></div>"):
        began = time.perf_counter()
        page = h.Page(markup * 100_000 + "end")
        assert page.pieces[-1][1].endswith("end") and time.perf_counter() - began < 20


def test_pages_without_articles(spark):
    """The model then keeps what is outside menus, footers and the like."""
    plain = lambda s: s.replace("<article>", "<div>").replace("</article>", "</div>")
    rows = [(i, u, plain(s)) for i, u, s, _ in made()]
    model = h.train(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = h.extract_all([plain(r[2]) for r in made(40, seed=2)], model)
    assert np.mean([a == r[3] for a, r in zip(got, made(40, seed=2))]) > 0.9


def test_odd_pages(spark, model):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<p>"), (3, "u", "<div>" * 3000 + "deep"), (4, "u", "<p>" + "word " * 60_000)]
    got = h.extract_text(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string"), model).collect()
    assert len(got) == 6 and all(r.text == "" for r in got if r.page_id in (1, 2, None))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert h.extract_text(empty, h.train(empty)).collect() == []


def test_same_pages_give_the_same_model(spark, model):
    again = h.train(spark.createDataFrame([r[:3] for r in made()][::-1], "page_id long, url string, html string"))
    assert all(np.array_equal(a[2], b[2]) for a, b in zip(model.trees, again.trees))
    assert re.match(r"^\S", "x")
