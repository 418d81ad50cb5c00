"""Classifiers, page text and licence scan."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hotbeat.llm import html_text, license_scan, quality, toxicity
from hotbeat.llm.common import held_out
from hotbeat.llm.license_rules import rules

SF = "/root/testdata/sf0.01"
EDGE = "doc_id long, text string, score double, labels string, n_words long, toxicity string, quality string, h long, y int"


def edge(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "x", 1, "a", "b", 2, 3) for r in rows], EDGE)


ROWS = [(1, "An ordinary text of some words."), (2, None), (3, ""), (None, "no id here"), (1, "An ordinary text of some words."), (4, "long " * 40_000)]


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_edge_cases(spark, tables, module, label):
    model = module.fit(*tables)
    got = module.score(edge(spark, ROWS), model, column="made").collect()
    assert len(got) == len(ROWS) and all(0 <= r["made"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["text"] or "", set()).add(r["made"])
    assert all(len(v) == 1 for v in by.values())  # null scores as empty, repeated rows alike
    assert module.score(edge(spark, []), model, column="made").count() == 0


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_missing_labels_give_a_constant(spark, tables, module, label):
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = module.fit(tables[0], none)
    assert {r["made"] for r in module.score(edge(spark, ROWS), model, column="made").collect()} <= {0.0, 1.0}


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_labels_and_labels_of_other_documents_are_never_learnt(spark, module, label):
    import zlib

    rows = [(i, f"{'vile wicked' if i % 3 == 0 else 'calm plain'} words number {i} and more of them " * 3, int(i % 3 == 0)) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    plain = spark.createDataFrame([(i, y) for i, _, y in rows], f"doc_id long, {label} int")
    other = spark.createDataFrame([(i, 1 if i in held else y) for i, _, y in rows] + [(i, 1) for i in range(1000, 1500)], f"doc_id long, {label} int")
    scores = [[r[0] for r in module.score(docs, module.fit(docs, lab), column="s").orderBy("doc_id").select("s").collect()] for lab in (plain, other)]
    assert len(held) > 20 and scores[0] == scores[1]


def test_long_documents_are_learnt_from_all_over_and_ids_of_any_type(spark):
    from hotbeat.llm import common

    docs = spark.createDataFrame([(f"d{i}", ("a" * 50_000 + "b" * 50_000 + "c" * 100_000) if i % 2 else "short") for i in range(20)] + [("x", None)], "doc_id string, text string")
    labels = docs.selectExpr("doc_id", "CAST(length(text) > 10 AS INT) AS quality")
    rows = common.training_sample(docs, labels, "quality", 5)
    long = [t for t, y in rows if y == 1]
    assert len(rows) == 10 and len(long) == 5 and all(len(t) <= common.LONGEST_LEARNT + common.SPREAD and {*t} == {*"abc "} for t in long)
    counts = common.label_counts(docs, labels, "quality")
    assert sum(counts.values()) == sum(1 for r in docs.select("doc_id", common.held_out().alias("h")).collect() if not r["h"] and r["doc_id"] != "x")


def test_held_out_rule(spark):
    import zlib

    got = spark.range(300).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_quality_on_held_out_documents(spark, tables):
    got = E.queries()["op5_quality"](spark, SF).join(tables[1], "doc_id").where("held_out").toPandas()
    assert auc(got["score"].to_numpy(), got["quality"].to_numpy()) > 0.95


def test_toxicity_finds_planted_words(spark):
    """Insults put into generated prose at random places are learnt; prose without them stays clean."""
    rng = random.Random(8)
    syllables = ["ba", "do", "ki", "lu", "mer", "tan", "sol", "vi", "rek", "pon"]
    vocabulary = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(600)]
    insults = ["grumblefoot", "snorklehead", "wretchling"]
    docs, labels = [], []
    for i in range(800):
        words = rng.choices(vocabulary, k=rng.randint(30, 300))
        toxic = i % 4 == 0
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")  # noqa: E741
    got = toxicity.score(d, toxicity.fit(d, l)).join(l, "doc_id").where(held_out()).toPandas()
    flagged = got["toxicity"] >= 0.5
    assert (flagged & (got["toxic"] == 1)).sum() >= 0.9 * (got["toxic"] == 1).sum()
    assert (flagged & (got["toxic"] == 0)).sum() <= 0.02 * (got["toxic"] == 0).sum()


def test_attention_gradients():
    rng = np.random.default_rng(2)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 5)]
    make = lambda *s: rng.normal(0, 0.5, s)
    w = {"W": make(quality.FEATURES, 4), "b": make(4), "V": make(4, 3), "U": make(4, 3), "w": make(3), "c": make(4), "d": make(1)}
    lengths = np.array([len(b) for b in bags])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    x, y = np.concatenate(bags), np.array([1.0, 0.0, 1.0])

    def loss():
        z = quality._forward(w, x, starts, lengths)["logit"]
        return np.mean(np.logaddexp(0, z) - y * z)

    for name, g in quality._gradients(w, x, starts, lengths, y).items():
        at = tuple(rng.integers(0, s) for s in w[name].shape)
        w[name][at] += 1e-6
        up = loss()
        w[name][at] -= 2e-6
        down = loss()
        w[name][at] += 1e-6
        assert abs((up - down) / 2e-6 - g[at]) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class=top><a href="/">Site</a></header><nav><ul><li>One</li><li>Two</li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy</div><article><header><h1>Head &amp; line</h1></header><p>First&nbsp;  para <b>bold</b>text<br>more
<p>Second &lt;tag&gt;</p><div class="comments"><p>Reader says</p></div><form><p>Name</p></form><aside>Side</aside><p>Last</p></article>
<p>outside</p><footer>&copy; x</footer></body></html>"""


def test_lines_of_a_page():
    text = html_text.main_text(html_text.lines_of(PAGE), None)
    assert text == "Head & line\nFirst para boldtext more\nSecond <tag>\nLast"
    assert html_text.lines_of("") == [] and html_text.lines_of("<p") == []
    assert html_text.main_text(html_text.lines_of("<p>a &am"), None) == "a &am"


@pytest.mark.parametrize("page,text", [
    ('<body class="right-sidebar search"><main class="content no-sidebar"><article class="post comments-open comment"><p>Body', "Body"),
    ('<body id=login><div class="sidebar right"><nav>Menu</nav><article id=social><p>Body</p></article></div>', "Body"),
    ('<form id=aspnetForm><nav>Menu</nav><article><p>Body</p></article></form>', "Body"),
    ('<nav>Menu of many, many long words</nav><form><div>Body of the page</div></form><form>Search</form>', "Body of the page"),
    ('<article><h2 id="social-history">Social</h2><h2 id=search>Search</h2><section id="search-algorithms"><p>A</p></section>'
     '<div class="related-work"><p>B</p></div><div class="related"><p>C</p></div></article>', "Social\nSearch\nA\nB"),
    ('<div class="content-with-sidebar"><p>Body</p></div><div class="sidebar">Side</div><div id="menu">Menu</div>', "Body"),
    ("<main><article><p>Body</p></article><section id='comments'><p>Reader one</p><p>Reader two is long</p></section></main>", "Body"),
    ("<main><p>Body of the page</p><div id='sidebar'>Side</div><div id='ad'>Buy</div><ul id='nav'><li>Menu</li></ul></main>", "Body of the page"),
    ("<article><p>Body of a page</p><ul id='nav'><li>Menu</li></ul><div class='post-comments'>Reader</div><div class='sidebar-right'>Side</div>"
     "<div class='cookie-bar'>Cookies</div><div id='reader_comments'>R</div></article>", "Body of a page"),
    ("<article><a href='#search'>Go</a><div id='search'><p>On search</p></div><a href='#comments'>2 comments</a><div id='comments'>Reader</div></article>",
     "Go\nOn search\n2 comments"),
    ("<article><div id='social'><p>Nearly all of the text of this page</p></div><p>Rest</p></article>", "Nearly all of the text of this page\nRest"),
    ('<main><article><p>Body</p></article><div id=comments class=comments-area><article class=comment-body>Reader</article></div></main>', "Body"),
])
def test_marks_of_wrappers(page, text):
    assert html_text.main_text(html_text.lines_of(page), None) == text


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(6)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = (rng.choices("abcd", k=rng.randrange(0, 12)) for _ in range(2))
        marked = html_text.shared_lines(a, b)
        kept = [x for x, m in zip(a, marked) if m]
        assert len(kept) == length(a, b)
        it = iter(b)
        assert all(x in it for x in kept)


def test_pages_without_article_lose_what_neighbours_share(spark):
    page = lambda body: f"<html><body><div>Site name</div><div>Menu of things</div>{body}<div>All about us</div></body></html>"
    rows = [(i, f"https://h.example/a/{i:03d}", page(f"<p>Own text {i}</p>"), "x") for i in range(40)]
    rows += [(100, None, None, "x"), (101, "nonsense", "", "x"), (None, "https://alone.example/x", page("<p>Alone</p>"), "x"), (0, rows[0][1], rows[0][2], "x")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows)
    by = {(r["page_id"], r["url"]): r for r in got}
    assert all(by[i, f"https://h.example/a/{i:03d}"]["text"] == f"Own text {i}" for i in range(2, 39))
    assert by[100, None]["text"] == "" and by[100, None]["n_chars"] == 0
    assert by[None, "https://alone.example/x"]["text"] == "Site name\nMenu of things\nAlone\nAll about us"


def test_copies_and_partition_edges_do_not_decide(spark):
    """Every page keeps its own lines and loses the menu, wherever partitions are cut and however many copies stand beside it."""
    page = lambda i: f"<div>Site name</div><div>Menu of things</div><p>Own text {i} of a page with some length</p><div>All about us</div>"
    dated = lambda i, d: page(i) + "<p>" + f"More text of page {i}. " * 20 + f"</p><div>{d}</div>"
    rows = [(i, f"https://a.example/p/{i:03d}", page(i)) for i in range(60)]
    rows += [(100 + j, f"https://b.example/same?session={j}", page(7)) for j in range(50)] + [(200, "https://b.example/z", page(8))]
    rows += [(300 + j, f"https://c.example/copy/{j:03d}", dated(5, j)) for j in range(40)] + [(400, "https://c.example/z", dated(6, 0))]
    rows += [(500 + j, f"https://d.example/only/{j}", page(9)) for j in range(20)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 30)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["page_id"]: r["text"] for r in html_text.extract(frame).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    own = lambda i: f"Own text {i} of a page with some length"
    assert len(got) == len(rows)
    assert all(got[i] == own(i) for i in range(60))
    assert all(got[100 + j] == own(7) for j in range(50)) and got[200] == own(8)
    more = lambda i: own(i) + "\n" + " ".join([f"More text of page {i}."] * 20)
    # dates that stand in both pages are shared
    assert all(got[300 + j] == more(5) + (f"\n{j}" if j else "") for j in range(40)) and got[400].startswith(more(6))
    assert all(got[500 + j] == f"Site name\nMenu of things\n{own(9)}\nAll about us" for j in range(20))


def test_pages_with_article_or_main_are_differenced(spark):
    """What neighbours share in a main element is their template; what an article holds stays, however often it comes."""
    page = lambda i: (f"<div>Site name</div><main><p>Our offers to you</p><article><p>Own text {i} of a page</p><p>Quoted by all of them</p></article>"  # noqa: E731
                      f"<p>After word {i}</p><p>Read on below</p></main><div>Plain {i}</div>")
    only = lambda i: f"<main><p>Our offers to you</p><p>Own text {i} of a page with some length</p></main><div>Plain {i}</div>"
    rows = [(i, f"https://a.example/{i:03d}", page(i)) for i in range(12)] + [(100 + i, f"https://b.example/{i:03d}", only(i)) for i in range(12)]
    rows += [(200, "https://c.example/a", "<main><p>Same</p></main>"), (201, "https://c.example/b", "<main><p>Same</p></main><div>Some other lines of it</div>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"Own text {i} of a page\nQuoted by all of them\nAfter word {i}" for i in range(12))
    assert all(got[100 + i] == f"Own text {i} of a page with some length" for i in range(12))
    assert got[200] == got[201] == "Same"


def test_page_text_of_the_table(spark):
    """Brute force: cut the article out by its tags."""
    import html

    got = {r["page_id"]: r for r in E.queries()["op4_html_text"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        m = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", m[1] if m else "")]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def scan_brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    tagged = "".join(f" {w}#{i}" for i, w in enumerate(words))
    spans = lambda e: [(int(re.search(r"#(\d+)", m)[1]), int(re.search(r"#(\d+)$", m)[1])) for m in
                       (m[0] for m in re.finditer(license_scan.tagged_expression(e), tagged))]
    base = sorted((f, label) for phrase, label in license_scan.BASE.items() for f, _ in spans(phrase))
    hits = [(f, last, p, n, label) for n, p, label, _, e in rules() for f, last in spans(e)]
    kept = [x for x in hits if not any(y[0] <= x[0] and y[1] >= x[1] and y[2] >= x[2]
                                       and (y[0] < x[0] or y[1] > x[1] or y[2] > x[2] or y[3] < x[3]) for y in hits)]
    starts = [f for f, _ in base]
    sure = max([license_scan.CONFIDENCE[x[2]] for x in kept] + [license_scan.BASE_CONFIDENCE] * bool(base), default=0.0)
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in base})),
            ",".join(sorted({b for _, b in base} | {x[4] for x in kept})), sure)


def test_scan_equals_brute_force(spark):
    rng = random.Random(9)
    phrases = [re.sub(r"\(\?:([^|)]*)\|?[^)]*\)\??", r"\1", e).replace("[cs]", "s").replace("?", "").replace("[^ ]+ ", "").replace("{0,12}", "") for *_, e in rules()]
    texts = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc  CC-BY-NC", "Apache License, Version 2.0 x", "",
             "Cöpyright under the mit license under\nthe MIT\tlicense", "GPL-3.0 and the BSD 3-clause licence", "K licence K"] + [
        " ".join(rng.choices(phrases + ["filler words", "the", "license", "mit"], k=rng.randint(1, 8))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + ROWS
    got = license_scan.scan(edge(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        have = tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
        assert have == scan_brute(r["text"]), r["text"]
    assert license_scan.scan(edge(spark, [])).count() == 0


def variants(expression):
    """Texts that an expression matches: each optional group left out, and each of its alternatives."""
    m = re.search(r"\(\?:([^()]*)\)(\?|\{0,\d+\}|\{1,\d+\})?", expression)
    if not m:
        yield expression.replace("[cs]", "s").replace("[1-4] [05]", "4 0").replace("[^ ]+", "word").replace("?", "")
        return
    for choice in m[1].split("|") + ([""] if m[2] and not m[2].startswith("{1") else []):
        yield from variants(expression[:m.start()] + choice + expression[m.end():])


def test_keywords_are_in_every_match():
    for _, _, _, keyword, expression in rules():
        for text in variants(expression):
            assert re.fullmatch(expression, text), (expression, text)
            assert keyword in text, (keyword, text)
            assert re.search(license_scan.CC_BY, text) or any(a in text for a in license_scan.ANCHORS), text


def test_rules_are_well_formed():
    found = rules()
    assert len(found) >= 200
    for _, priority, _, keyword, expression in found:
        assert priority in license_scan.CONFIDENCE
        re.compile(license_scan.tagged_expression(expression))


def test_scan_is_native(spark):
    plan = E.queries()["op10_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
