import html
import random
import re

from larder.llm import extraction
from larder.llm.extraction import blocks, repeated, unique_text


def test_structure():
    page = """<!DOCTYPE html><html class="nav-open"><head><title>No</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li><a href="x>y">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div><div id="cookie-notice">We use</div>
    <article><header><h1>The&nbsp;title &amp; more</h1><p>By me</p></header><p>One <b>bold</b>er
      text<br>next<script>var t="</p>";</script><p class="promo">no<p>Two &lt;b&gt; &#233;<aside>no</aside><ul><li>first<li>second</ul>
    <form>no<input></form><div class="article-body">In&copy;<div hidden>no</div></div><section class="comments"><article>reader</article></section><footer>no</footer></article>
    <div>after</div><footer>&copy;</footer></body></html>"""
    texts, vouched = blocks(page)
    assert vouched and texts == ["The title & more", "One bolder text next", "Two <b> é", "first", "second", "In©"]
    assert blocks(None) == ([], False) and blocks("") == ([], False) and blocks("plain  text")[0] == ["plain text"]
    assert blocks("<main><p>a</main><p>b")[0] == ["a"] and blocks("<p>a<p>b < c & d")[0] == ["a", "b < c & d"]
    assert blocks("<article><p>x</p>" + "<b>" * 3000 + "y</article>z") == (["x", "y"], True)


def _brute(streams, run):
    places = {}
    for i, s in enumerate(streams):
        for j in range(len(s) - run + 1):
            places.setdefault(tuple(s[j : j + run]), set()).add(i)
    out = []
    for s in streams:
        cover = [0] * len(s)
        for j in range(len(s) - run + 1):
            for k in range(j, j + run):
                cover[k] = max(cover[k], len(places[tuple(s[j : j + run])]))
        out.append(cover)
    return out


def test_repeats_against_brute_force():
    r = random.Random(4)
    for _ in range(60):
        streams = [r.choices("abc", k=r.randrange(0, 30)) for _ in range(r.randrange(1, 8))]
        for run in (1, 2, 4):
            assert [c.tolist() for c in repeated(streams, run)] == _brute(streams, run)


def test_open_blocks_keep_their_unique_runs():
    menu = ["Home", "About us", "Our products and services today", "Contact us now"]
    pages = [menu + [f"This is page {i} with words of its own " + " ".join(f"w{i}x{j}" for j in range(20))] + ["All rights of this long footer text are kept by us"] for i in range(5)]
    got = unique_text(pages, [False] * 5)
    assert got == [p[4] for p in pages]
    assert unique_text(pages, [True] * 5) == ["\n".join(p) for p in pages]
    many = [["Said on each and every page of this host here", f"own text {i}"] for i in range(60)]
    assert unique_text(many, [True] * 60) == [f"own text {i}" for i in range(60)]


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in extraction.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = r["html"][r["html"].index("<article>") : r["html"].index("</article>")]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1|article)>", article.replace("<br>", " "))]
        assert got[r["page_id"]]["text"] == "\n".join(p for p in parts if p)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


def test_edges_and_large_hosts(spark):
    schema = "page_id long, url string, html string, host string, text string"
    assert extraction.extract(spark.createDataFrame([], schema)).count() == 0
    body = "<div>Menu of the site with many words in it always</div><div>Own words number {0} " + "and{0} " * 10 + "</div>"
    rows = [(i, f"http://HOT.example/{i}", body.format(i), "h", "t") for i in range(900)] + [(901, None, None, "h", "t"), (902, "nourl", "", "h", "t"), (None, "http://x/", "<p>a</p>", "h", "t"), (5, "http://HOT.example/5", body.format(5), "h", "t")]
    got = extraction.extract(spark.createDataFrame(rows, schema).repartition(5)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None and r["page_id"] < 900:
            assert r["text"] == f"Own words number {r['page_id']} " + " ".join([f"and{r['page_id']}"] * 10)
    assert {r["page_id"]: r["text"] for r in got if r["page_id"] in (901, 902, None)} == {901: "", 902: "", None: "a"}


def test_copies_keep_their_text():
    menu = "Home and all of our other pages are to be found here"
    copy = [menu, "The text of the copied page " + " ".join(f"c{j}" for j in range(30))]
    others = [[menu, f"Own text {i} " + " ".join(f"w{i}x{j}" for j in range(20))] for i in range(6)]
    for n in (2, 49, 50, 60, 3000):
        assert unique_text([copy] * n, [False] * n) == unique_text([copy] * n, [True] * n) == ["\n".join(copy)] * n
        assert unique_text([copy] * n + others, [False] * (n + 6)) == [copy[1]] * n + [p[1] for p in others]
        assert unique_text([copy] * n + others, [True] * (n + 6)) == ["\n".join(copy)] * n + ["\n".join(p) for p in others]
    passage = "a long passage that two pages of the host share word for word"
    two = [[*p, passage] if i < 2 else p for i, p in enumerate(others)]
    assert unique_text(two, [False] * 6) == [f"{p[1]}\n{passage}" if i < 2 else p[1] for i, p in enumerate(others)]


def test_copies_over_many_shards(spark):
    body = "<div>Said on one page that has very many copies in the host</div>"
    rows = [(i, f"http://h.example/?page={i}", wrap.format(body)) for k, wrap in enumerate(("{}", "<article>{}</article>")) for i in range(k * 1000, k * 1000 + 1000)]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 2000 and {r["text"] for r in got} == {"Said on one page that has very many copies in the host"}


def test_runs_are_counted_over_all_shards_of_a_host(spark):
    """Shares at their edge, copies in many shards, and rows of one page that differ, against the whole host as one shard."""
    r, footer = random.Random(7), "This footer stands on some of the pages of the host and goes there"
    own = lambda i: f"<div>Own words of page {i} " + " ".join(f"w{i}x{j}" for j in range(20)) + "</div>"
    rows = [("exact.x", i, own(i) + (f"<div>{footer}</div>" if i < 70 else "")) for i in range(700)]  # just a tenth
    rows += [("under.x", 1000 + i, own(i) + (f"<div>{footer}</div>" if i < 69 else "")) for i in range(700)]
    rows += [("copies.x", 2000 + i, own(i // 20) + (f"<div>{footer}</div>" if i < 60 else "")) for i in range(600)]  # 30 contents, three with it
    rows += [("twice.x", 3000 + i, own(i) + (f"<div>{footer}</div>" if i < 49 else "")) for i in range(500)]
    rows += [("twice.x", 3000 + i, own(i + k) + f"<div>{footer}</div>") for i, k in ((60, 9000), (61, 0), (0, 9001), (62, 3), (63, 1))]
    r.shuffle(rows)
    got = extraction.extract(spark.createDataFrame([(i, f"http://{h}/{i}", t) for h, i, t in rows], "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    texts = {(g["page_id"], g["text"]) for g in got}
    assert not any(footer in t for i, t in texts if i < 700) and sum(footer in t for i, t in texts if 1000 <= i < 1700) == 69
    assert not any(footer in t for i, t in texts if 2000 <= i < 2600)
    want = set()
    pages = [(i, blocks(t)[0]) for h, i, t in rows if h == "twice.x"]
    frame = spark.createDataFrame(pages, "page_id long, blocks array<string>").selectExpr("*", "xxhash64(blocks) AS content").toPandas().sort_values("content")
    one = {i: list(b) for i, b in frame.drop_duplicates("page_id")[["page_id", "blocks"]].itertuples(index=False)}
    for i, b in pages:
        others = [o for j, o in one.items() if j != i]
        want.add((i, unique_text([b, *others], [False] * (1 + len(others)))[0]))
    assert {t for t in texts if t[0] >= 3000} == want


def test_short_pages_of_a_host_of_many_shards(spark):
    """Contents of fewer tokens than a run hold no run; they keep their text."""
    long = "<div>Own words of page {0} " + " ".join(f"w{{0}}x{j}" for j in range(20)) + "</div>"
    rows = [(i, f"http://h.example/{i}", long.format(i)) for i in range(500)]
    short = {1000 + n: " ".join(f"s{j}" for j in range(n)) for n in range(1, 9)}
    rows += [(i, f"http://h.example/{i}", f"<div>{text}</div>") for i, text in short.items()]
    rows += [(2000, "http://h.example/2000", "<article><p>Two words.</p><p>Two words.</p></article>")]
    got = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and got[2000] == "Two words.\nTwo words."
    assert {i: got[i] for i in short} == short and got[7].startswith("Own words of page 7 w7x0")
