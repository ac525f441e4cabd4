"""Vector operators against plain Python versions, and page extraction."""

import math
import random

import numpy as np
import plain
import pytest

from tickhouse.llm import html_text, topk, vectors
from tickhouse.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, score int, id long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)

    def vector(n=16):
        return [rng.gauss(0, 1) for _ in range(n)]

    out = []
    for i in range(260):
        v = vector()
        if i % 3 == 0 and out:
            v = [x + rng.gauss(0, 0.12) for x in rng.choice(out)[2]]
        out.append((i, i % 2, v))
    out += [(400 + i, 1, out[0][2]) for i in range(5)]
    import numpy as np
    out = [(i, label, [float(x) for x in np.float32(v)]) for i, label, v in out]
    bad = [None, [], [1.0, None], [1.0, float("nan")], [float("inf"), 0.0], [0.0] * 16]
    out += [(500 + k * 50, 0, v) for k, v in enumerate(bad)]
    return [*out, (900, None, out[3][2]), (901, 0, [1.0, 2.0]), (903, 0, [2.0, 4.0])]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 0, 0) for i, label, v in rows], SCHEMA)


def test_top_k(table, rows):
    want = plain.top([(i, v) for i, _, v in rows])
    for options in ({}, {"candidates": 40, "queries": 2}):
        got = topk.search(table, **options).collect()
        assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want


def test_reading_stops_early_and_loses_nothing():
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 8)) * 300
    x[:4] = x[100] + rng.normal(size=(4, 8))
    x = np.floor(x).astype(np.int64)
    lists = topk.Lists(np.arange(3000), x.astype(float))
    ids = np.array([100, 7, 2999])
    free = np.full(3, -np.inf)
    left = lists._survivors(ids, x[ids].astype(float), free, 3)
    assert left[0].sum() < 300
    for bars in (free, [x[q] @ x[q] * 0.1 for q in ids]):
        found = list(lists.top(ids, x[ids].astype(float), np.array(bars, float), 10))
        for q, bar, (who, scores) in zip(ids, bars, found, strict=True):
            every = sorted((-int(x[i] @ x[q]), i) for i in range(3000) if i != q)[:10]
            want = [(s, i) for s, i in every if -s >= bar]
            got = [(-int(s), int(i)) for i, s in zip(who, scores, strict=True)]
            assert got[:len(want)] == want


def test_a_query_that_a_block_cannot_serve_reads_nothing():
    rng = np.random.default_rng(1)
    far = topk.Lists(np.arange(2_000), rng.integers(-9, 9, (2_000, 8)).astype(float))
    q = rng.integers(-9, 9, (2, 8)).astype(float)
    alive = far._survivors(np.array([-1, -2]), q, np.array([1e6, -np.inf]), 10)
    assert not alive[0].any() and alive[1].any()


def test_any_finite_component_takes_part(spark):
    rng = random.Random(3)
    big = [2.0 ** 40, -(2.0 ** 21), 1e12, -3e5, 1e-9, 0.0, 7.25]
    rows = [(i, [rng.choice(big) for _ in range(4)]) for i in range(120)]
    rows += [(200, [float("inf")] * 4), (201, [1.7e308] * 4), (202, [float("nan")] * 4), (300, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score)
           for r in topk.search(df, every=40, candidates=30, queries=2).collect()}
    end = 2 ** 63
    want = {}
    kept = [(i, [math.floor(1024 * v) for v in x]) for i, x in rows if i < 200]
    for q, x in kept:
        if q % 40 == 0:
            scores = [(-max(-end, min(end - 1, sum(a * b for a, b in zip(x, y)))), i)
                      for i, y in kept if i != q]
            for rank, (score, i) in enumerate(sorted(scores)[:10], 1):
                want[q, rank] = (i, -score)
    assert got == want


def test_vector_links(table, rows):
    want = plain.vector_links(rows)
    assert sum(n > 0 for n, _ in want.values()) > 60
    for options in ({}, {"cells": 9, "block": 16, "reach": 100.0},
                    {"cells": 2, "split": 40, "move": 0.0, "block": 16, "reach": 100.0}):
        got = vectors.links(table, **options).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_cells_find_most_links(spark):
    """Recall of the default reach on links at the limit, where it is least."""
    import numpy as np
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = rng.normal(size=x.shape)
    step -= (step * x).sum(axis=1, keepdims=True) * x
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    y = 0.935 * x + math.sqrt(1 - 0.935**2) * step
    data = [(i, [float(a) for a in v], 0) for i, v in enumerate(np.vstack([x, y]))]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = vectors.links(df, cells=16).where("n_links > 0").count()
    assert got >= 0.99 * 800


def _linked_pairs(rng, n, dim, rank, flat=0.0):
    """n / 2 unit vectors of a rank, and a partner of each at cosine 0.935."""
    basis = rng.normal(size=(rank, dim)) if rank < dim else np.eye(dim)
    basis *= (np.arange(1, len(basis) + 1) ** -flat)[:, None]
    unit = vectors.unit
    x = unit(rng.normal(size=(n // 2, len(basis))) @ basis)
    step = rng.normal(size=(n // 2, len(basis))) @ basis
    step = unit(step - (step * x).sum(axis=1, keepdims=True) * x)
    return x, 0.935 * x + math.sqrt(1 - 0.935**2) * step


@pytest.mark.parametrize("dim,rank,flat,cells", [
    (64, 64, 0.0, 60), (384, 8, 0.0, 5), (384, 8, 0.0, 60), (512, 6, 0.0, None),
    (256, 40, 0.0, 60), (128, 128, 1.0, None), (128, 128, 0.5, 60)])
def test_recall_at_the_limit_for_any_rank(dim, rank, flat, cells):
    """Partners at the limit share a cell, with production limits, over 12,000 vectors."""
    rng = np.random.default_rng(rank)
    x, y = _linked_pairs(rng, 12_000, dim, rank, flat)
    both = np.vstack([x, y])
    centres, limits = vectors.plan_cells(
        both[rng.permutation(len(both))], np.zeros(len(both)), len(both), vectors.MAX_CELLS,
        vectors.REACH, cells=cells)
    shared = vectors.cells_of(x, centres, limits) & vectors.cells_of(y, centres, limits)
    assert shared.any(axis=1).mean() >= 0.99


def test_large_cells_are_cut_and_every_link_is_counted_once(spark):
    """Low-rank vectors at production limits, against products of all pairs."""
    rng = np.random.default_rng(5)
    x = np.vstack(_linked_pairs(rng, 12_000, 48, 6)).astype(np.float32)
    df = spark.createDataFrame(
        [(i, [float(a) for a in v], 0) for i, v in enumerate(x)],
        "vec_id long, embedding array<float>, label int")
    got = vectors.links(df, cells=4, split=2_000, move=100.0).select("vec_id", "n_links").toPandas()
    u = vectors.unit(x)
    want = np.concatenate([(part @ u.T >= vectors.COSINE).sum(axis=1) - 1
                           for part in np.array_split(u, 12)])
    found = got.sort_values("vec_id")["n_links"].to_numpy()
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum()


def test_a_dense_group_is_not_cut():
    rng = np.random.default_rng(6)
    x = vectors.unit(1 + 0.01 * rng.normal(size=(3_000, 32)))
    centres, _ = vectors.plan_cells(x, np.zeros(3_000), 50_000, vectors.SPLIT_CELLS, vectors.REACH)
    assert len(centres) == 1


def test_empty_vector_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.search(none).count() == 0 and vectors.links(none).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 4)]
    groups = plain.Groups()
    for a, b in edges:
        if a is not None and a != b:
            groups.join(a, b)
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.component for r in got} == {i: groups.root(i) for i in groups.up}


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style>
<script>if (a < b) document.write("<p>no</p>")</script></head><body>
<header class="top"><p>Site name</p></header><nav><ul><li><a href="/a">Home</a></ul></nav>
<div class='cookie-notice'>We use cookies and ask you at some length whether you agree.</div>
<article><header><h1>A  title</h1></header><p>One&nbsp;&lt;b&gt; <b>bold</b>
word &#8212; done.<p>Yes.<!-- <p>hidden</p> --><ul><li>first<li>second <a href=x>link</a></ul>
<div class="share-buttons">Share this</div><form><label>Name</label><input></form>
<section id="comments"><p>A reader says many words here that are no part of it.</p></section>
<p>Last<br>line</p></article><aside>Other things to read on this site today</aside>
<footer>&copy; all of us</footer></body></html>"""


def test_page_text():
    assert html_text.main_text(PAGE) == (
        "A title\n\nOne <b> bold word — done.\n\nYes.\n\nfirst\n\nsecond link\n\nLast line")


def test_page_without_marked_elements():
    long = "A paragraph of an article with quite a few words in it, so that it counts as text. " * 3
    page = f"<div><a href=1>Home</a> <a href=2>News</a></div><div>{long}</div><p>{long}</p>" \
           "<div><a href=3>Next page of the list</a></div>"
    assert html_text.main_text(page) == f"{long.strip()}\n\n{long.strip()}"


def test_elements_without_end_tags():
    text = "A paragraph of the article."
    article = f"<article><h1>Title</h1><p>{text}<p>{text}</article>"
    want = f"Title\n\n{text}\n\n{text}"
    for one in ("<li><a href=/x>x</a>", "<p>words", "<div>", "<dt>a<dd>b", "<li><p>a<div>b</div>"):
        assert html_text.main_text(f"<nav><ul>{one * 200}</ul></nav>{article}") == want
    rows = "<tr><th>a<td>b" * 200
    assert html_text.main_text(f"<aside><table>{rows}</table></aside>{article}") == want
    # In the middle of an article, and an item that is apart before one that is not.
    page = f"<article><p>{text}<nav><ol>{'<li>x' * 200}</ol></nav><p>{text}</article>"
    assert html_text.main_text(page) == f"{text}\n\n{text}"
    for kind in ("li", "dd", "p", "td", "tr"):
        page = f"<article><{kind} class=share>Share<{kind}>{text}<div>{text}</div></article>"
        assert html_text.main_text(page) == f"{text}\n\n{text}"
    # An item of an inner list ends no item of the outer one.
    page = f"<article><ul><li class=share>Share<ul><li>this<li>too</ul>now<li>{text}</ul></article>"
    assert html_text.main_text(page) == text
    assert html_text.main_text(f"<head><meta charset=utf-8><title>T</title>{article}") == want


def test_class_and_id_words_are_hints():
    long = "A paragraph of the article with many words and no link, which is what tells it. " * 2
    short = "A short one of a few words."
    for around in ('section id="related-work"', 'div class="side-by-side"', "p class=notice",
                   'div id="legal-background"', 'div data-id="comments"', 'section id="search"'):
        name = around.split()[0]
        inside = long if name == "p" else f"<h2>Search methods</h2><p>{long}</p><p>{short}</p>"
        page = f"<article><p>{short}</p><{around}>{inside}</{name}><p>{short}</p></article>"
        middle = [long.strip()] if name == "p" else ["Search methods", long.strip(), short]
        assert html_text.main_text(page) == "\n\n".join([short, *middle, short])
    page = f"<body class='with-sidebar'><article><h2 id='search-methods'>Search</h2>{long}</article>"
    assert html_text.main_text(page) == f"Search\n\n{long.strip()}"
    links = "<a href=/x>Another page of this site to read</a> " * 12
    for apart in ("<div class=ad>Buy this</div>", f"<div class=related>{links}</div>",
                  f"<nav>{long}</nav>", f"<aside><p>{long}</aside>", f"<form>{long}</form>",
                  f"<div role=navigation>{long}</div>", "<p class=share>Share this"):
        page = f"<article><p>{long}</p>{apart}<p>{long}</p></article>"
        assert html_text.main_text(page) == f"{long.strip()}\n\n{long.strip()}", apart


def test_tree_learns_its_rows():
    import numpy as np

    rows = np.array(html_text.LABELLED, float)
    assert (html_text.judge(html_text.trained(), rows[:, :-1]) == rows[:, -1]).all()


def test_odd_pages(spark):
    pages = [None, "", "<p", "<article>open <b>text", "<" * 5000, "<script>x", "<a href='" * 500,
             "<article><p>" + "word " * 200_000 + "</p></article>", "<article></article>"]
    df = spark.createDataFrame(
        [(i, "u", p, "x") for i, p in enumerate(pages)],
        "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert got[0].text == got[1].text == got[8].text == "" and got[0].n_chars == 0
    assert got[3].text == "open text" and got[7].n_chars == 200_000 * 5 - 1
    assert html_text.extract(df.limit(0)).count() == 0
