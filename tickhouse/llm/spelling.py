"""Spelling variants: words one edit apart, and the frequent form each goes back to.

The vocabulary is counted with built-in functions. Its words are then laid in sorted
lists. A list belongs to a length m and holds words of m and m + 1 letters that
share their first ``lo`` and last ``hi`` letters; what differs is the window between.
In a window of r letters one edit leaves the first or the last r // 2 letters alone,
so a list that is too long is cut into those two kinds of lists, again and again:
all pairs one edit apart still meet, exactly once each (``below``: a pair belongs to
the list of the first kind if both could hold it). A window of one letter ends that:
such a list has at most a few thousand words, the alphabet being what it is. So no
list grows with the vocabulary, and no pair is formed but inside a list.

A list is scanned once per word of length m. The scan keeps the rows of a banded
edit matrix, one row a letter of the word in the list. The next word keeps the rows
of the letters that it shares with the one before it, and where a row already
exceeds one edit all words that share that prefix are passed over.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.shared import apart, drop_stored, lower_ascii, store

RUN = r"[A-Za-zÀ-ÿ]+"
#: The shortest word and the fewest occurrences of one.
SHORTEST, FEWEST = 6, 5
#: A form is at least so many times as frequent as its variant.
TIMES = 5
#: Of so many (document, run) hashes one loses a letter.
EVERY = 199
#: Words of a list; longer lists are cut. Lists with a window of one letter may be longer.
LIST = 1_000
#: Beyond every position.
_FAR = (1 << 31) - 1


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """word, n: how often each word occurs in all texts.

    Counts combine before the shuffle, so a word as frequent as can be is one row a
    task. A null text has no words; a repeated row counts again; a null doc_id hashes
    as an empty one.
    """
    runs = docs.select("doc_id", F.explode(
        F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    lowered = runs.select("doc_id", lower_ascii(F.col("run")).alias("run")).where(
        F.length("run") >= shortest)
    hashed = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                              F.lit(":"), F.col("run")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    word = F.when(F.col("h") % EVERY != 0, F.col("run")).otherwise(
        F.concat(F.substring(F.col("run"), F.lit(1), at),
                 F.substring(F.col("run"), at + 2, F.length("run"))))
    words = lowered.withColumn("h", hashed).select(word.alias("word"))
    return (
        words.where(F.length("word") >= shortest)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= fewest)
    )


# -- lists -----------------------------------------------------------------------------

_KEY = ("m", "lo", "hi", "below", "head", "tail")


def _laid(words: DataFrame) -> DataFrame:
    """Each word in the list of its length and in that of one letter less."""
    size = F.length("word")
    return words.withColumn("m", F.explode(F.array(size, size - 1))).select(
        "m", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(_FAR).alias("below"),
        F.lit("").alias("head"), F.lit("").alias("tail"), F.col("word").alias("window"), "n")


def _cut(lists: DataFrame) -> DataFrame:
    """Lists of a window of two letters or more -> lists of their halves."""
    half = F.floor((F.col("m") - F.col("lo") - F.col("hi")) / 2).cast("int")
    left = F.struct(
        "m", (F.col("lo") + half).alias("lo"), "hi", "below",
        F.concat("head", F.substring(F.col("window"), F.lit(1), half)).alias("head"), "tail",
        F.substring(F.col("window"), half + 1, F.length("window")).alias("window"), "n")
    right = F.struct(
        "m", "lo", (F.col("hi") + half).alias("hi"),
        F.least("below", F.col("lo") + half).alias("below"), "head",
        F.concat(F.substring(F.col("window"), F.length("window") - half + 1, half),
                 F.col("tail")).alias("tail"),
        F.substring(F.col("window"), F.lit(1), F.length("window") - half).alias("window"), "n")
    # Where all letters before ``below`` are shared, every pair belongs to another list.
    return (lists.select(F.explode(F.array(left, right)).alias("x")).select("x.*")
            .where("lo < below"))


def _can_cut() -> Column:
    return F.col("m") - F.col("lo") - F.col("hi") >= 2


def lists(words: DataFrame, longest: int = LIST) -> DataFrame:
    """Rows of all lists, none longer than ``longest`` unless its window is one letter.

    A step counts the lists (combined before the shuffle) and cuts the long ones. A
    list may hold a third of all rows: its rows are joined with the count of its key,
    which a skewed join may split, and are never brought together before it is cut.
    """
    laid = _laid(words)
    done, rest = [], store(_cut(laid.where(_can_cut())).unionByName(laid.where(~_can_cut())),
                           "spelling")
    while True:
        long = apart(rest.where(_can_cut()).groupBy(*_KEY).count()
                     .where(F.col("count") > longest).drop("count"))
        marked = store(rest.join(long.withColumn("__long", F.lit(True)), list(_KEY), "left"),
                       "spelling-marked")
        drop_stored(rest)
        done.append(marked.where("__long is null").drop("__long"))
        again = marked.where("__long")
        if again.isEmpty():
            break
        rest = store(_cut(again.drop("__long").select(*rest.columns)), "spelling")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# -- one list --------------------------------------------------------------------------


def near_in_list(windows: list[str], start: int, word: str) -> list[int]:
    """Places from ``start`` on, in a sorted list, of words one edit from ``word``.

    Row d of the matrix has the edits that turn ``word``'s first d - 1, d and d + 1
    letters into the first d of the word in the list, with 2 for all that is more.
    """
    found, total, size = [], len(windows), len(word)
    rows = [(2, 0, 1 if size else 2)]
    before, at = "", start
    while at < total:
        other = windows[at]
        long = len(other)
        depth = min(len(commonprefix((before, other))), len(rows) - 1)
        del rows[depth + 1:]
        a, b, c = rows[depth]
        while depth < long:
            if a > 1 and b > 1 and c > 1:
                break
            letter = other[depth]
            # A letter past the end of ``word`` ends no way of editing it.
            x = a + (word[depth - 1] != letter) if 0 < depth <= size else 2
            if b + 1 < x:
                x = b + 1
            y = b + (word[depth] != letter) if depth < size else 2
            if depth < size:
                y = min(y, c + 1, x + 1)
            z = c + (word[depth + 1] != letter) if depth + 1 < size else 2
            if depth + 1 < size and y + 1 < z:
                z = y + 1
            a, b, c = x if x < 2 else 2, y if y < 2 else 2, z if z < 2 else 2
            depth += 1
            rows.append((a, b, c))
        before = other
        if a > 1 and b > 1 and c > 1:
            # All words with these ``depth`` letters exceed one edit.
            at = bisect_left(windows, other[:depth] + "\U0010ffff", at + 1)
            continue
        if depth == long and -1 <= size - long <= 1 and (a, b, c)[size - long + 1] == 1:
            found.append(at)
        at += 1
    return found


def _pairs_of(m: int, lo: int, hi: int, below: int, head: str, tail: str,
              rows: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    """rows: (window, n) of one list, sorted -> word, n, near word, its n; both ways."""
    short, r = [], m - lo - hi
    windows = [w for w, _ in rows]
    for place, window in enumerate(windows):
        if len(window) == r:
            short.append(place)
    by_size = {r: short, r + 1: [i for i, w in enumerate(windows) if len(w) == r + 1]}
    for size, places in by_size.items():
        others = [windows[i] for i in places]
        for k, place in enumerate(short):
            window, n = rows[place]
            for hit in near_in_list(others, k + 1 if size == r else 0, window):
                other, other_n = rows[places[hit]]
                if lo + len(commonprefix((window, other))) < below:
                    yield head + window + tail, n, head + other + tail, other_n
                    yield head + other + tail, other_n, head + window + tail, n


def near_pairs(words: DataFrame, longest: int = LIST) -> DataFrame:
    """word, n -> word, n, near, near_n: every pair one edit apart, both ways, once.

    ``word`` is unique in ``words``.
    """
    laid = lists(words, longest)
    ordered = laid.repartition(*_KEY).sortWithinPartitions(*_KEY, "window").select(
        *_KEY, "window", "n")
    shape = pa.schema([("word", pa.string()), ("n", pa.int64()),
                       ("near", pa.string()), ("near_n", pa.int64())])

    def out(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ready = None, [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *own, window, n in zip(*columns, strict=True):
                if own != key:
                    if len(held) > 1:
                        ready.extend(_pairs_of(*key, held))
                    key, held = own, []
                    if len(ready) >= 10_000:
                        yield out(ready)
                        ready = []
                held.append((window, n))
        if len(held) > 1:
            ready.extend(_pairs_of(*key, held))
        yield out(ready)

    return ordered.mapInArrow(scan, "word string, n bigint, near string, near_n bigint")


# -- forms -----------------------------------------------------------------------------


def forms(words: DataFrame, times: int = TIMES, longest: int = LIST) -> DataFrame:
    """word, n -> word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word (of equal ones the first), if that
    is ``times`` as frequent; its root is where forms lead. An empty vocabulary
    gives no rows.
    """
    words = store(words.select("word", "n"), "spelling-words")
    best = near_pairs(words, longest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.max("near_n").alias("form_n"),
        F.min_by("near", F.struct(-F.col("near_n"), "near")).alias("form"))
    is_form = F.col("form_n") >= times * F.col("n")
    formed = store(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"),
        F.when(is_form, F.col("form_n")).alias("form_n")), "spelling-formed")
    # Frequencies grow along forms, so there is an end; each step doubles the way gone.
    steps = store(formed.where("form is not null").select("word", F.col("form").alias("root")),
                  "spelling-roots")
    while True:
        ahead = apart(steps.select(F.col("word").alias("root"), F.col("root").alias("__ahead")))
        further = store(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("__ahead", "root").alias("root"),
            F.col("__ahead").isNotNull().alias("__moved")), "spelling-roots")
        drop_stored(steps)
        steps = further.drop("__moved")
        if further.where("__moved").isEmpty():
            break
    return formed.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """The words of all texts with their forms and roots."""
    return forms(vocabulary(docs))
