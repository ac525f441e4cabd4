"""Secret models on any id and beside base spans; what pages leave out; large ids; shuffles."""

import os
import random
import string
import time

import pytest

from tickhouse.llm import html_text, lines, minhash, mixing, secrets, substrings
from tickhouse.llm.shared import store
from tickhouse.sources.staged import release

WORDS = ("the service reads configuration from internal storage and writes reports about usage "
         "every morning before other teams start their work on documents").split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    ids = [2**63 - 1, -(2**63), 2_000_000_000_000_000, -1, 0, None, *range(1, 300)]
    return spark.createDataFrame(
        [(i, " ".join(rng.choices(WORDS, k=80))) for i in ids], "doc_id long, text string")


@pytest.fixture(scope="module")
def table(docs):
    return secrets.train(secrets.labelled_samples(docs))


def score(table, token):
    return sum(table[ord(a) * 128 + ord(b)] for a, b in zip(token, token[1:]))


def plain_extra(table, text, base):
    """What the model reports, in plain Python: tokens less base spans, by their score."""
    import re

    found = []
    for m in re.finditer(secrets.TOKEN, text):
        upto, pieces = m.start(), []
        for start, end in sorted((b.start, b.end) for b in base):
            if start < m.end() and m.start() < end:
                pieces.append((upto, start))
                upto = max(upto, end)
        pieces.append((upto, m.end()))
        found += [p for p in pieces
                  if p[1] - p[0] >= secrets.LEAST and score(table, text[slice(*p)]) >= secrets.THRESHOLD]
    return found


def random_of(rng, n, letters=string.ascii_letters + string.digits):
    return "".join(rng.choices(letters, k=n))


def test_random_strings_of_sixteen_letters_and_more_are_found(table):
    rng = random.Random(2)
    for n in range(16, 41):
        for letters in (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits,
                        "0123456789ABCDEF"):
            hits = sum(score(table, random_of(rng, n, letters)) >= secrets.THRESHOLD for _ in range(200))
            assert hits >= 190, (n, letters)


def test_ordinary_tokens_are_not(table):
    rng = random.Random(3)
    for _ in range(2_000):
        token = rng.choice("_-./=").join(rng.choices(WORDS, k=rng.randint(2, 5)))
        assert len(token) < 16 or score(table, token) < secrets.THRESHOLD, token


def test_what_base_spans_leave_of_a_token(spark, table):
    rng = random.Random(4)
    hexes = [random_of(rng, 32, "0123456789abcdef") for _ in range(40)]
    texts = [None, "", f"id/{hexes[0]}/sig={random_of(rng, 40)} x",
             f"{hexes[1]}.{random_of(rng, 30)}.{hexes[2]}", f"token={random_of(rng, 30)}/{hexes[3]}",
             f"a {random_of(rng, 17)} b", f"AKIA{'A' * 20}/{random_of(rng, 24)}={hexes[4]}"]
    for k in range(5, 35):
        texts.append("/".join(rng.choice((hexes[k], random_of(rng, rng.randint(3, 40)), "plain.words",
                                          "secret=abcdefghij", "x")) for _ in range(rng.randint(1, 6))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.scan(df, table).collect()
    for r in found:
        assert [(x.start, x.end) for x in r.extra] == plain_extra(table, r.text, r.base), r.text
        assert all(r.text[x.start:x.end] == x.value for x in r.extra)
    assert sum(len(r.extra) for r in found) > 10


def test_any_id_is_scanned(docs):
    assert secrets.digest(docs).count() == docs.count()


# -- pages -----------------------------------------------------------------------------

FILL = "Plain words without any link go on here for a while. " * 4
AROUND = "<article><p>" + "Start of it. " * 20 + "</p>{}<p>" + "End of it. " * 20 + "</p></article>"


@pytest.mark.parametrize("open_tag", [
    '<section class="comments">', '<ol class="comment-list"><li>', '<div class="sidebar">',
    '<div class="cookie-notice">', '<div class="advertisement">', '<div class="advert box">',
    '<section id="comments">', '<div id="disqus_thread">', '<ul class="replies"><li>',
    '<div class="newsletter-signup">', '<div class="left-sidebar">', "<div class=notice>"])
def test_what_is_named_without_doubt_is_left_out(open_tag):
    for around in (AROUND, AROUND.replace("article>", "main>")):
        text = html_text.main_text(around.format(f"{open_tag}{FILL}</{open_tag.split()[0][1:]}>"))
        assert "Plain" not in text and "Start" in text and "End" in text


@pytest.mark.parametrize("open_tag", [
    '<section id="related-work">', '<div class="side-by-side">', '<div id="legal-background">',
    '<section id="notice-of-terms">', '<h2 class="comments">', '<section id="comments-on-method">',
    '<p class="comment">', '<div class="post sponsored">', '<div class="search-methods">'])
def test_hints_leave_it_to_words_and_links(open_tag):
    text = html_text.main_text(AROUND.format(f"{open_tag}{FILL}</{open_tag.split()[0][1:]}>"))
    assert "Plain" in text


@pytest.mark.parametrize("piece", [
    "<a ", "<svg>x", '<a "x>" ', "</svg ", "<!--", '<div class="a" ', '<a href="x', "<svg", "<?",
    "<p><svg>", "<script", "</script ", "<", "<li>"])
def test_a_megabyte_of_open_markup_takes_seconds(piece):
    began = time.time()
    html_text.main_text("<p>text" + piece * (1_000_000 // len(piece)))
    html_text.main_text(piece * (1_000_000 // len(piece)) + ">")
    assert time.time() - began < 10


def test_ids_of_pages_are_not_touched(spark):
    ids = [9007199254740993, None, 2**63 - 1]
    df = spark.createDataFrame(
        [(i, f"u{i}", "<p>" + FILL, 1) for i in ids], "page_id long, url string, html string, text int")
    found = html_text.extract(df.coalesce(1)).collect()
    assert [r.page_id for r in found] == ids and all(r.n_chars == len(r.text) for r in found)


# -- stored tables ---------------------------------------------------------------------


def test_shuffles_of_a_stored_table_end_with_it(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    frame = store(spark.range(1_000).repartition(5, "id"), "test", clean=True)
    assert frame.count() == 1_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_substring_tables_are_few_at_the_end(spark):
    rng = random.Random(6)
    passage = " ".join(random_of(rng, 5) for _ in range(70))
    rows = [(i, f"{random_of(rng, 9)} {passage} {random_of(rng, 9)}") for i in range(30)]
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    substrings.digest(spark.createDataFrame(rows, "doc_id long, text string"), "leftover").count()
    names = {n.split("leftover")[1].rsplit("-", 1)[0]
             for n in os.listdir(f"{base}/tickhouse") if "leftover" in n}
    assert names == {"-rows", "-parts", "-joined", "-least"}


# -- lines -----------------------------------------------------------------------------


def test_first_occurrences_come_from_a_sorted_pass(spark):
    line = "A line of more than forty characters in many documents"
    rows = [(i, f"{line}\nown {i}\n{line}", i % 3) for i in range(40)] + [(3, f"x\n{line}", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pos int")
    found = lines.occurrences(lines.line_hashes(docs))
    plan = found._jdf.queryExecution().executedPlan().toString()
    steps = [x.strip(" +-*:") for x in plan.splitlines()]
    assert any(x.startswith("Exchange rangepartitioning(h1") for x in steps)
    assert any(x.startswith("Sort [h1") and "pos" in x for x in steps)
    assert sum("Exchange" in x for x in steps) == 1
    by_doc = {r.doc_id: [p.pos for p in r.places] for r in found.collect()}
    assert by_doc == {**{i: [0, 2] for i in range(40)}, 3: [0, 1, 2]}


def test_helper_names_as_columns_of_the_documents(spark):
    """Every step's own names beside the text come back as they were."""
    extra = ["__doc", "__version", "__own", "__keep", "__id", "__size", "__finish", "__text",
             "d", "p", "size", "finishes", "keep", "component", "id"]
    rows = [(i, f"A line of more than forty characters in many documents\nown words {i} of text",
             "s", *range(len(extra))) for i in range(8)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in extra))
    for step in (lines.dedup, minhash.dedup, mixing.mix):
        out = step(docs)
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(tuple(r)[3:] == tuple(range(len(extra))) for r in found)


def test_release_leaves_no_table_of_an_operator(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    rows = [(i, "many words of a text that comes again " * 9) for i in range(5)]
    substrings.digest(spark.createDataFrame(rows, "doc_id long, text string"), "released").count()
    assert any("released" in n for n in os.listdir(f"{base}/tickhouse"))
    release(spark)
    assert not any("released" in n for n in os.listdir(f"{base}/tickhouse"))
