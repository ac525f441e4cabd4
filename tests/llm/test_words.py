"""Pieces, infilling and spelling variants against the library and plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickhouse.llm import infill, pieces, spelling

CLASHING = ("doc_id long, text string, ids string, n long, form string, word string, `__a` int, "
            "agrees int, `__text` string, n_tokens_ int, n_tokens int")


def table(spark, rows):
    """Rows of (doc_id, text) beside columns that results, or steps on the way, are named by."""
    return spark.createDataFrame(
        [(i, t, "x", 1, "f", "w", 2, 3, "t", 4, 5) for i, t in rows], CLASHING).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- pieces ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(pieces.model_file(), "rb") as f:
        return pieces.Model(f.read())


def awkward(rng, n):
    alphabet = " " * 6 + "▁aeinrstx\n\t\x00é日本𝒳�1.<>/sAB²'"
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)]


def test_encodes_and_decodes_as_the_library(model):
    texts = awkward(random.Random(2), 3_000) + [
        "", " ", "  two", "a  b ", "▁a", "<s> </s>", "<0x41>", "x" * 3_000, " " * 999, "日" * 500,
        "ab" * 2_000, "aaaaab" * 400]
    for text, theirs in zip(texts, model.library.encode(texts), strict=True):
        ours = model.encode(text)
        assert ours == theirs, text
        assert model.decode(ours) == model.library.decode(ours), text
    assert model.disagreeing() == set()


def test_decodes_any_ids_as_the_library(model):
    rng = random.Random(3)
    for _ in range(3_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3), 259])
               for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == model.library.decode(ids), ids


def test_list_and_heap_agree(model):
    rng = random.Random(4)
    for _ in range(500):
        symbols = rng.choices("▁▁aeinrstho", k=rng.randint(1, 60))
        few, many = list(symbols), list(symbols)
        model._merge_few(few)
        model._merge_many(many)
        assert few == many


def test_a_part_that_the_library_encodes_otherwise_is_named(model):
    model.fresh.append(("▁house", (1, 2)))
    assert model.disagreeing() == {"▁house"}


def test_forgotten_parts_come_back(model, monkeypatch):
    monkeypatch.setattr(pieces, "PARTS", 3)
    text = "one two three four five one two three one"
    assert model.encode(text) == model.library.encode(text)


def test_pieces_of_a_table(spark, model):
    rng = random.Random(5)
    texts = [None, "", *awkward(rng, 150), "long " * 20_000]
    rows = [(k // 2, t) for k, t in enumerate(texts)] + [(None, "null id"), (1, "one"), (1, "one")]
    found = pieces.digest(table(spark, rows), pieces.model_file()).collect()
    want = []
    for i, t in rows:
        ids = model.library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(model.library.decode(ids)), True))
    assert Counter(map(tuple, found)) == Counter(want)
    whole = pieces.tokenised(table(spark, rows), pieces.model_file())
    assert whole.columns == [
        "doc_id", "ids_", "n", "form", "word", "__a", "agrees_", "__text_", "n_tokens_",
        "n_tokens__", "n_tokens", "ids", "decoded", "agrees"]
    assert {(r.doc_id, r.decoded) for r in whole.collect()} == {
        (i, (t or "").replace("▁", " ")) for i, t in rows}
    empty = pieces.digest(table(spark, rows).limit(0), pieces.model_file())
    assert empty.collect() == []


def test_foreign_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    with open(pieces.model_file(), "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        pieces.Model(proto.SerializeToString())


# -- infilling -------------------------------------------------------------------------


def infilled(i, text, units=list):
    text = text or ""
    parts = units(text)
    n = len(parts)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m = "".join(parts[:a]), "".join(parts[a:b])
    s = text[len(p) + len(m):]
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return n, form, a, b - a, out


def infill_rows():
    rng = random.Random(6)
    texts = [None, "", " ", "x", "\n\r\n", "$1 \\1 \\Q \\E $", "a<P>b", "<S>", "<M", "<<P", "𝒳é日" * 50,
             "long text\n" * 20_000]
    texts += ["".join(rng.choices("ab\n\r 𝒳é<PSM>$\\", k=rng.randint(0, 60)))
              for _ in range(200)]
    return [(k, t) for k, t in enumerate(texts)] + [(None, "null id"), (5, "$1 again"), (5, "$1 again")]


def test_infill(spark):
    rows = infill_rows()
    found = Counter(map(tuple, infill.digest(table(spark, rows)).collect()))
    want = Counter()
    for i, t in rows:
        *numbers, out = infilled(i, t)
        want[(i, *numbers, sha(out), sha(t or ""))] += 1
    assert found == want
    forms = Counter(r[2] for r in found.elements())
    assert all(forms[f] > 10 for f in ("plain", "psm", "spm"))
    assert infill.digest(table(spark, rows).limit(0)).collect() == []


def test_infill_of_words_is_one_match_without_recursion(spark):
    rows = [(k, t) for k, t in [(0, "word " * 60_000), (1, "a b  c\nd"), (2, "one"), (3, " ")]]
    got = {r.doc_id: (r.n, r.form, r.prefix_units, r.middle_units, r.output)
           for r in infill.transform(table(spark, rows), unit=r"\S+\s*").collect()}
    assert got == {i: infilled(i, t, lambda x: re.findall(r"\S+\s*", x)) for i, t in rows}


def test_infill_stays_in_the_jvm(spark):
    plan = infill.digest(table(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


# -- spelling --------------------------------------------------------------------------


def near(a, b):
    """Whether two words differ by one letter, by trying all edits."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants(counts):
    best, partners = {}, {w: [v for v in counts if near(w, v)] for w in counts}
    for w, found in partners.items():
        top = min(found, key=lambda v: (-counts[v], v), default=None)
        best[w] = top if top and counts[top] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while best[root]:
            root = best[root]
        out.add((w, best[w], root, counts[w], len(partners[w]),
                 counts[best[w]] if best[w] else None))
    return out


def counted(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def word_rows():
    rng = random.Random(7)
    base = ["".join(rng.choices("abÀé÷", k=rng.randint(6, 9))) for _ in range(60)]
    words = []
    for k, w in enumerate(base):
        words += [w] * (5 + 40 * (k % 3))
        for _ in range(4):
            at, c = rng.randrange(len(w)), rng.choice("abÀéz")
            words += [rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:],
                                  w[:at] + c + w[at + 1:]])] * rng.choice((4, 5, 6, 30, 200))
    words += ["Abcdef", "ABCDEG", "abcdeÉ"] * 7 + ["x" * 500] * 9 + ["x" * 501] * 60
    rng.shuffle(words)
    rows = [(k, rng.choice(" ,.1\n").join(words[k * 20:k * 20 + 20])) for k in range(len(words) // 20 + 1)]
    return [*rows, (None, " ".join(words[:200])), (9, None), (10, ""), (11, "42 !"), rows[0], rows[0]]


@pytest.mark.parametrize("longest", [3, 1_000])
def test_spelling(spark, longest):
    rows = word_rows()
    words = spelling.vocabulary(table(spark, rows))
    assert {(r.word, r.n) for r in words.collect()} == set(counted(rows).items())
    found = spelling.forms(words, longest=longest).collect()
    assert len(found) == len({r.word for r in found})
    assert {tuple(r) for r in found} == variants(counted(rows))


def test_spelling_of_nothing(spark):
    assert spelling.variants(table(spark, [(1, None), (2, "short")])).collect() == []
    assert spelling.variants(table(spark, [(1, "x")]).limit(0)).collect() == []


def test_pairs_come_once_and_from_short_words_too(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(700)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    want = {(a, b) for a in words for b in words if near(a, b)}
    for longest in (1, 20, 10_000):
        found = [(r.word, r.near) for r in spelling.near_pairs(df, longest).collect()]
        assert len(found) == len(set(found))
        assert set(found) == want


def test_lists_stay_short(spark):
    """A third of all words behind one prefix, and lists are still cut to the limit."""
    rng = random.Random(9)
    words = sorted({"commonprefix" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(1_500)}
                   | {"".join(rng.choices("abcdefgh", k=18)) for _ in range(3_000)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    sizes = spelling.lists(df, 50).groupBy(*spelling._KEY).agg(F.count(F.lit(1)).alias("n"))
    wide = sizes.where("m - lo - hi >= 2")
    assert wide.agg(F.max("n")).first()[0] <= 50


def test_scan_of_a_list_against_all_pairs():
    rng = random.Random(10)
    for _ in range(300):
        words = sorted({"".join(rng.choices("abc", k=rng.randint(0, 6))) for _ in range(40)})
        word = "".join(rng.choices("abc", k=rng.randint(0, 6)))
        hits = {words[k] for k in spelling.near_in_list(words, 0, word)}
        assert hits == {w for w in words if near(w, word)}
