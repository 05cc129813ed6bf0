"""Edge cases of single operators, recall and held-out figures."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate as D
from tessera.llm import fingerprint, html_extract, quality, token_scan, toxicity
from tests.llm.test_advice_r01 import brute, raw_of
from tests.llm.test_operators import words

MODEL = html_extract.train(html_extract.LABELLED)
LINE = "The harbour was quiet in the morning, and the boats that had come in overnight lay low in the water, waiting for the tide to turn."


def test_deep_wrappers_keep_their_text():
    for n in (1, 6, 30, 3000):
        wrapped = "<span>" * n + LINE + "</span>" * n
        assert html_extract.extract(f"<body><nav><a href=/>Home</a></nav><article><p>{wrapped}</p><p>{LINE}</p></article><footer>x</footer></body>", MODEL) == f"{LINE}\n\n{LINE}"
        wrapped = "<b><i><em class='css-1x9'>" * n + LINE + "</em></i></b>" * n
        assert html_extract.extract(f"<body><article><p>{wrapped}</p></article></body>", MODEL) == LINE
    boxes = "<div>" * 40 + f"<p>{LINE}</p><p>{LINE}</p>" + "</div>" * 40
    assert html_extract.extract(f"<body><main><article>{boxes}</article></main><aside><p>{LINE}</p></aside></body>", MODEL) == f"{LINE}\n\n{LINE}"


def test_formulas_and_fallbacks_stay():
    page = f"<article><p>{LINE}</p><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><p><object data=a.pdf>see the table below</object></p></article>"
    assert html_extract.extract(page, MODEL) == f"{LINE}\n\nHere x=2 holds.\n\nsee the table below"


@pytest.mark.parametrize("page", ["<span></b>", "<div><p>", "<table><tr><td><b></section>", "<ul><li><p></div>", "<!", "<a title=\"", "<li><span></p>", "</p>", "<p><i></table>"])
def test_time_grows_with_the_page(page):
    def took(n):
        began = time.process_time()
        html_extract.extract(page * n, MODEL)
        return time.process_time() - began

    took(100)
    small, large = took(2000), took(16_000)
    assert large < 30 * max(small, 0.01), (small, large)


#: Pages in other templates than those that the model is trained on: (page, blocks of the article).
HELD_OUT = [
    (f"<html><body><div id='top-bar'><a href='/'>Paper</a> <a href='/s'>Sport</a></div><div class='main-column'><div class='headline'><h1>Low tide</h1></div><div class='article-text'><p>{LINE}</p><p>Two.</p><p>{LINE} <a href='/m'>More here</a>.</p></div></div><div class='sidebar-right'><h4>Most read</h4><ul><li><a href='/1'>One thing</a></li><li><a href='/2'>Another</a></li></ul></div><div id='footer-wrap'><p>All rights reserved. {LINE}</p></div></body></html>", ["Low tide", LINE, "Two.", f"{LINE} More here."]),
    (f"<body><header><nav><ul><li><a href='/'>Start</a></li></ul></nav></header><section id='post'><h2>Notes</h2><p>{LINE}</p><ol><li>First, look.</li><li>Then, leap.</li></ol><blockquote>{LINE}</blockquote></section><section class='comments-area'><h3>3 comments</h3><div class='comment-body'><p>{LINE}</p></div></section><footer><a href='/about'>About</a></footer></body>", ["Notes", LINE, "First, look.", "Then, leap.", LINE]),
    (f"<body><div role='banner'><a href='/'>Site</a></div><div role='main'><h1>Boats</h1><table><tr><td>Length</td><td>12 m</td></tr></table><p>{LINE}</p><pre>a  b</pre></div><div class='ad-slot'><p>Buy boats at once, they are cheap this week only.</p></div><div class='cookie-banner'><p>We use cookies. {LINE}</p></div></body>", ["Boats", "Length", "12 m", LINE, "a b"]),
    (f"<body><article class='entry'><h1>Title</h1><div class='share-buttons'><a href='#'>Share</a> <a href='#'>Send</a></div><p>{LINE}</p><form><p>Your mail address</p><input></form><p>{LINE}</p><div class='related-posts'><h3>Related</h3><ul><li><a href='/x'>Other</a></li></ul></div></article><div id='sidebar'><p>{LINE}</p></div></body>", ["Title", LINE, LINE]),
    (f"<body><div class='nav'><a href='/a'>A</a><a href='/b'>B</a></div><div class='container'><div class='row'><div class='col-8'><h1>Plain</h1><p>{LINE}</p><p>{LINE}</p><p>End.</p></div></div></div><div class='popup newsletter'><p>Sign up for news. {LINE}</p></div></body>", ["Plain", LINE, LINE, "End."]),
    (f"<body><main><h1>Day &amp; night</h1><p>{LINE}</p><dl><dt>Ebb</dt><dd>{LINE}</dd></dl><figure><img src=a><figcaption>The harbour</figcaption></figure></main><aside class='promo'><p>{LINE}</p></aside><noscript><p>Enable scripts</p></noscript></body>", ["Day & night", LINE, "Ebb", LINE, "The harbour"]),
]


def html_figures():
    right = found = wanted = 0
    for page, blocks in HELD_OUT:
        got = html_extract.extract(page, MODEL).split("\n\n")
        left = list(blocks)
        for g in got:
            if g in left:
                left.remove(g)
                right += 1
        found += len(got)
        wanted += len(blocks)
    return right / found, right / wanted


def test_held_out_pages():
    precision, recall = html_figures()
    assert precision >= 0.9 and recall >= 0.95, (precision, recall)


def test_recall_of_edited_items_against_exhaustive_search():
    """Items of 5 to 60 words in longer texts, with words or characters edited up to the threshold."""
    rng = np.random.default_rng(21)
    for n in (5, 8, 12, 20, 35, 60):
        for kind in ("characters", "words"):
            items, docs = [words(n, 31 * n + t) for t in range(40)], []
            for t, x in enumerate(items):
                k = D.allowed(len(x))
                if kind == "characters":
                    chars = list(x)
                    for at in rng.choice(len(chars), k, replace=False).tolist():
                        way = int(rng.integers(0, 3))
                        chars[at] = "" if way == 0 else ("" if way == 1 else chars[at]) + chr(97 + int(rng.integers(0, 26)))
                    x = "".join(chars)
                else:
                    w = x.split()
                    for at in rng.choice(n, k // 5, replace=False).tolist():
                        w[at] = words(1, 9000 + at)
                    x = " ".join(w)
                docs.append(words(60, 17 * t + 1) + " " + x + " " + words(60, 17 * t + 2))
            found = {(r, i) for r, i, *_ in D.Index(list(range(40)), items).search(*raw_of(docs))}
            near = [t for t in range(40) if brute(items[t], docs[t]) <= D.allowed(len(items[t]))]
            assert len(near) >= 35
            assert sum((t, t) in found for t in near) >= 0.95 * len(near), (n, kind)
            assert all(brute(items[i], docs[r]) <= D.allowed(len(items[i])) for r, i in found)


def test_empty_benchmark_rows_extra_columns_and_long_text(spark):
    item = words(20, 1)
    bench = spark.createDataFrame([(None, item, "x"), (2, None, "y"), (3, " ", "z")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame([(1, words(20_000, 5) + " " + item, 7), (None, item, 8), (2, "", 9)], "doc_id long, text string, item_id int")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench).collect()}
    assert got == {(1, None), (None, None)}
    assert [(r["doc_id"], r["item_id"]) for r in D.clean_documents(docs, bench).collect()] == [(2, 9)]


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    return (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality", "quality", (0.98, 0.95, 0.95)), ("op9_toxic_spans", "toxic", (0.9, 0.85, 0.75))])
def test_held_out_accuracy(spark, name, label, least):
    from tessera.llm import queries

    d = "/root/testdata/sf0.1"
    rows = queries.queries()[name](spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", label), "doc_id").where(F.col(label).isNotNull()).toPandas()
    y, p = rows[label].to_numpy() == 1, rows["predicted"].to_numpy() == 1
    figures = auc(rows["score"].to_numpy(), y), (p & y).sum() / max(p.sum(), 1), (p & y).sum() / y.sum()
    print(name, len(rows), int(y.sum()), [round(float(x), 3) for x in figures])
    assert all(a >= b for a, b in zip(figures, least, strict=True)), figures


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_on_odd_tables(spark, operator):
    rows = [(i, words(20, i) + (" vile vile" if i % 2 else ""), "own", "mine") for i in range(40)] + [(None, None, "own", "mine"), (50, words(30_000, 1), "own", "mine"), (51, "", "own", "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tagged string, spans_ string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    if operator is quality:
        out = quality.score(docs, quality.fit(docs, labels))
        none = quality.score(docs.limit(0), quality.fit(docs.limit(0), labels))
    else:
        out = toxicity.tag(docs, toxicity.fit(docs, labels))
        none = toxicity.tag(docs.limit(0), toxicity.fit(docs.limit(0), labels))
    got = out.collect()
    assert len(got) == len(rows) and all(r["tagged"] == "own" and r["spans_"] == "mine" and 0 <= r["score"] <= 1 for r in got)
    assert none.count() == 0


def test_toxic_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 10, "x" * 100 + str(i)) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    texts, y = toxicity.labelled_texts(docs, labels, 3, 4, 1 << 20)
    assert len(texts) == 7 and y.sum() == 3
    texts, y = toxicity.labelled_texts(docs, labels, 3, 4, 350)
    assert sum(map(len, texts)) <= 350 and len(texts) == len(y) == 3


def test_the_end_is_no_token(tmp_path):
    import base64

    (tmp_path / "v").write_bytes(b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(256)))
    assert token_scan.id_width(str(tmp_path / "v"), 256) == 2
    assert token_scan.id_width(str(tmp_path / "v"), 70_000) == 4
    with pytest.raises(ValueError):
        token_scan.id_width(str(tmp_path / "v"), 255)


def test_ids_of_four_bytes(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_scan.document_token_counts(docs, end=70_000).collect()}
    assert got == {1: 3, 2: 0, 3: 0}


def test_fingerprints_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, sketch string, run string, guest string")
    assert fingerprint.edited_fingerprints(none).count() == 0
    rows = [(None, "a b c d e f"), (None, None), (5, "x y z"), (5, "x y z"), (6, "")]
    out = fingerprint.edited_fingerprints(spark.createDataFrame([(*r, "s", "r", "g") for r in rows], none.schema)).collect()
    assert len(out) == 5
    assert len({r["fingerprint"] for r in out if r["doc_id"] == 5}) == 1
