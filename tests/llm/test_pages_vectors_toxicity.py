import itertools
import math
import random
import zlib

import numpy as np
import pytest

from lakeops.llm import html_text, queries, toxicity, vectors

# -- pages -----------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="home nav-open"><header class="site-header"><a href="/">Logo</a></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice">We use cookies on this site to serve you better than ever before.</div>
<main><article><h1>Storm &amp; calm</h1><p>The <b>storm</b>
 came over   the hills at four o'clock, and nobody had expected it to stay so long.<p>It rained &lt;all&gt; day &copy; 2020<br>
and the river rose by two metres, which the town had not seen for thirty years.</p>
<div class="ad">Buy one umbrella and get the second one for free, only this week.</div>
<p>Yes.</p><blockquote>We will rebuild the bridge, said the mayor in the evening.</blockquote>
<form action="/s"><label>Mail</label><input name=q><button>Subscribe</button></form></article>
<section id="comments"><p>First! What a great article, I enjoyed reading this very much indeed.</p></section></main>
<aside><p>Related stories that you may also like to read on this site today.</p></aside>
<footer>&copy; 2020 The Paper, all rights reserved, no part may be copied.</footer></body></html>"""
TEXT = ("Storm & calm The storm came over the hills at four o'clock, and nobody had expected it to stay so long. "
        "It rained <all> day © 2020 and the river rose by two metres, which the town had not seen for thirty years. "
        "Yes. We will rebuild the bridge, said the mayor in the evening.")


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == TEXT


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- x", "<script>alert(1)", "</p></div>", "<p></p>", "&",
                                  "<a href='", "<" * 50, "<div>" * 3000])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_text.main_text(page), str)


def test_page_cut_short_keeps_its_text():
    assert html_text.main_text(PAGE[:PAGE.index("<div class=\"ad\"")]) == TEXT[:TEXT.index(" Yes.")]


WORDS = "Some words of the article that everyone can read today."


@pytest.mark.parametrize("page, text", [
    (f"<html><head><title>T</title><body><article><p>{WORDS}</article>", WORDS),
    (f"<head><meta charset=utf-8><title>T</title><link rel=x><p>{WORDS}", WORDS),
    (f"<head><title>T</title>{WORDS}", WORDS),
    (f"<div title=it's><p>{WORDS}</div><p>It's more of the same text, with words.",
     WORDS + " It's more of the same text, with words."),
    (f'<p title="a > b" lang=en>{WORDS}</p>', WORDS),
    (f"<p class=x/y data-role=nav>{WORDS}</p>", WORDS),
    (f"<article><p>{WORDS} <span hidden>SECRET</span><span style='color:red; display: none'>S</span>"
     "<i hidden=hidden>S<i>E</i>CRET</i><b aria-hidden=true>S</b>Shown.</article>", WORDS + " Shown."),
    (f"<article><p><span hidden>SECRET<p>{WORDS}</article>", WORDS),
    (f"<body><form action=/x><div><h1>Storm</h1><p>{WORDS}</p><label>Mail</label><input name=q><button>Go</button>"
     "</div></form>", "Storm " + WORDS),
    (f"<body><article><p>{WORDS} {WORDS}</p></article><form><h2>Write to us</h2><p>{WORDS}</form>", f"{WORDS} {WORDS}"),
    ("<body><form><p>Log in to go on reading</p><label>Name</label></form>", ""),
    (f"<div class='post copyright'><p>{WORDS}</p></div>", WORDS),
    (f"<article class='copyright'><p>{WORDS}</p></article>", WORDS),
    (f"<article><p>{WORDS}</p><div class='post-copyright'>No part may be copied or sold.</div></article>", WORDS),
    (f"<p>Fore<script>x</script>word: <!-->{WORDS}<!-- y --></p>", "Foreword: " + WORDS),
    (f"<svg><title/><path d='M0'/></svg><p>{WORDS}</p>", WORDS),
])
def test_valid_pages_written_in_other_ways(page, text):
    assert html_text.main_text(page) == text


def test_time_grows_with_the_page_however_deep_it_nests():
    import time
    start = time.process_time()
    for page in ("<div>x " * 50000, "<div>" * 50000 + "</section>" * 50000, "<p>x " * 50000, "<form>x" * 50000):
        html_text.main_text(page)
    assert time.process_time() - start < 30


def test_minimum_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(kept):
            return (sum(max(0, o) for o, k in zip(odds, kept) if not k) + sum(max(0, -o) for o, k in zip(odds, kept) if k)
                    + sum(c for a, b, c in edges if kept[a] != kept[b]))

        best = min(cost(kept) for kept in itertools.product([False, True], repeat=n))
        assert math.isclose(cost(html_text.minimum_cut(odds, edges)), best, abs_tol=1e-6)


def test_long_pages_and_awkward_rows(spark):
    long = "<article>" + "".join(f"<p>Paragraph {i} has some words in it to read.</p>" for i in range(3000)) + "</article>"
    pages = spark.createDataFrame([(1, "u", PAGE, 0), (1, "u", PAGE, 0), (2, None, None, 1), (None, "v", "", 1),
                                   (3, "w", long, 1), (4, "x", "plain words without any tags at all", 2)],
                                  "page_id long, url string, html string, n_chars int")
    frame = html_text.extract(pages)
    assert frame.columns == ["page_id", "url", "text", "n_chars"]
    rows = {(r.page_id, r.url): r for r in frame.collect()}
    assert frame.count() == 6 and rows[1, "u"].text == TEXT and rows[1, "u"].n_chars == len(TEXT)
    assert rows[2, None].text == rows[None, "v"].text == "" and rows[2, None].n_chars == 0
    assert rows[3, "w"].text == " ".join(f"Paragraph {i} has some words in it to read." for i in range(3000))
    assert rows[4, "x"].text == "plain words without any tags at all"
    assert html_text.extract(pages.limit(0)).collect() == []


def test_articles_of_the_given_pages(spark, tiny):
    import html
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    for r in queries.QUERIES["op1_html_text"](spark, tiny).collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", body)]
        assert r.text == " ".join(p for p in parts if p)


# -- vectors ---------------------------------------------------------------------------------------------------------

def brute(ids, rows, query, k):
    scores = [(-(rows[query] * rows[i]).sum(), ids[i]) for i in range(len(ids)) if ids[i] != ids[query]]
    return sorted(scores)[:k]


def test_vectors_of_the_given_table(spark, tiny):
    table = spark.read.parquet(f"{tiny}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, rows = [r.vec_id for r in table], np.array([r.embedding for r in table], float)
    got = {}
    for r in queries.QUERIES["op2_nearest_vectors"](spark, tiny).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    found = 0
    for query in [i for i in ids if i % 20 == 0]:
        mine = sorted(got[query])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)
        want = {i for _, i in brute(ids, rows, ids.index(query), 20)}
        found += len(want & {m[1] for m in mine})
        for _, i, score in mine:
            assert math.isclose(score, float(rows[ids.index(query)] @ rows[ids.index(i)]), abs_tol=1e-12)
    assert found >= 0.9 * 20 * len(got)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(i, [1.0, float(i % 3)]) for i in range(30)] + [(i, [2.0, 0.0]) for i in range(100, 140)]
    bad = [(200, None), (201, [0.0, 0.0]), (202, [1.0, None]), (203, [nan, 1.0]), (204, [inf, 1.0]), (None, [1.0, 1.0]),
           (205, []), (206, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in data + bad + data[:5]],
                                  "vec_id long, embedding array<double>, score int")
    rows = vectors.search(table, lambda i: i % 20 == 0, 20).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    ids, values = [i for i, _ in data], np.array([v for _, v in data])
    assert got == {q: brute(ids, values, ids.index(q), 20) for q in ids if q % 20 == 0}
    few = vectors.search(table.filter("vec_id < 4"), lambda i: i % 2 == 0, 20).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(q, i) for q in (0, 2) for i in range(4) if i != q]
    assert vectors.search(table.limit(0), lambda i: i > 0, 5).collect() == []
    assert vectors.search(table.filter("vec_id BETWEEN 200 AND 204"), lambda i: i > 0, 5).collect() == []


def test_blocks_give_the_same_result(spark, monkeypatch):
    rng = np.random.default_rng(1)
    table = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(300)],
                                  "vec_id long, embedding array<double>")
    whole = vectors.search(table, lambda i: i % 5 == 0, 7).collect()
    monkeypatch.setattr(vectors, "MOST_BLOCK", 10)
    monkeypatch.setattr(vectors, "LEAST_BLOCK", 10)
    monkeypatch.setattr(vectors, "BATCH_QUERIES", 4)
    monkeypatch.setattr(vectors, "QUERIES_AT_ONCE", 3)
    blocks = vectors.search(table, lambda i: i % 5 == 0, 7).collect()
    same = len({(r.query_id, r.vec_id) for r in whole} & {(r.query_id, r.vec_id) for r in blocks})
    assert len(whole) == len(blocks) == 420 and same > 410


# -- toxicity --------------------------------------------------------------------------------------------------------

def slow_kernel(one, two):
    def parts(word):
        out = {}
        for places in itertools.combinations(range(len(word)), 3):
            key = bytes(word[p] for p in places)
            out[key] = out.get(key, 0) + toxicity.DECAY ** (places[-1] - places[0] + 1)
        return out

    a, b = parts(one), parts(two)
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    return dot(a, b) / math.sqrt(dot(a, a) * dot(b, b))


def test_kernel_agrees_with_all_subsequences():
    words = [b"idiot", b"ixdiot", b"banana", b"abcabc", b"zzz", b"worthlessness"]
    got = toxicity._apply(toxicity._table(words), words)
    assert np.allclose(got, [[slow_kernel(a, b) for b in words] for a in words])


def test_terms_join_spelled_words_and_drop_signs():
    assert toxicity.terms_of("An i d i o t, id-iot! 1d10t") == {b"an", b"idiot", b"idiot"}
    assert toxicity.terms_of("") == set()


def test_held_out_scores(spark, tiny):
    folder = tiny.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.QUERIES["op7_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    pairs = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    area = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert area > 0.8 and max(bad) < 0.5


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(9)
    calm = ["river", "mountain", "window", "garden", "table", "morning", "evening", "paper", "music", "flower", "idol",
            "studio", "moral", "cloud", "winter", "summer", "people", "letter", "number", "silver"]
    rows = []
    for i in range(600):
        words = rng.choices(calm, k=60)
        if i % 3 == 0:
            words.insert(rng.randrange(60), rng.choice(["idiot", "moron"]))
        rows.append((i, " ".join(words) + "."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")


def test_gapped_and_inserted_characters(spark, insults):
    docs, labels = insults
    model = toxicity.train(docs, labels)
    scorer = toxicity.TermScorer(model)
    bad = ["You idiot", "you i d i o t", "idxiot", "id.iot", "IDIIOT", "m0ron", "moroon", "such an idiotxx here"]
    fine = ["", "river and mountain", "idol of the studio", "moral number"]
    assert (scorer.texts(bad) > 0).all() and (scorer.texts(fine) < 0).all()


def test_awkward_labels(spark, insults, awkward, no_documents):
    docs, labels = insults
    for part in (labels.limit(0), labels.filter("toxic = 1"), labels.filter("toxic = 0")):
        rows = toxicity.toxicity(awkward, part).collect()
        assert len(rows) == awkward.count() and all(r.predicted == 0 and 0 <= r.score <= 1 for r in rows)
    mixed = labels.union(spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, toxic int"))
    assert toxicity.toxicity(docs, mixed).count() == 600
    assert toxicity.toxicity(no_documents, labels).collect() == []
    kept = toxicity.drop_toxic(docs.selectExpr("*", "1 AS score", "'x' AS margin"), labels)
    assert kept.columns == ["doc_id", "text", "score", "margin"]
    assert {r.doc_id for r in kept.collect()} == {i for i in range(600) if i % 3}
