r"""Secret scan: fixed patterns, and character Markov models for the rest.

Two first-order character models, one of random strings and one of ordinary
identifiers, are trained from labelled samples. A long token whose letters are
``THRESHOLD`` nats likelier under the first (the log odds against a token being
a secret) is reported beside what the patterns find. Everything on the main path
is DataFrame functions; the trained table has a row for each pair of characters
of a fixed alphabet and class, and is the only thing that reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.shared import sample, store, texts

# The base patterns, their kinds in order, and least lengths.
KINDS = ("assign", "access", "hex", "model")
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_CHARS = 8
# A run of these letters is matched whole, so its least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

#: Tokens that the model scores, and the least length of what is left of one beside a
#: span of the patterns. Shorter ones have too few steps for any score to tell.
LEAST = 16
TOKEN = rf"[A-Za-z0-9+/_.=-]{{{LEAST},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
THRESHOLD = 12.0
SAMPLE_DOCS, SAMPLE_PARTS = 4000, 16


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """(start, kind, end, value) of the matches in ``text``, in code points.

    Matches and the pieces between them alternate, so their lengths add up to the
    places. ``value`` is the given group; matches whose value is shorter than
    ``least`` are dropped after matching, so they still use up their text.
    """
    def place(found: Column) -> Column:
        def with_pieces(pieces: Column) -> Column:
            def with_values(values: Column) -> Column:
                def one(match: Column, i: Column) -> Column:
                    def upto(array: Column, n: Column) -> Column:
                        return F.aggregate(
                            F.slice(array, 1, n), F.lit(0), lambda a, x: a + F.length(x))
                    start = upto(pieces, i + 1) + upto(found, i)
                    return F.struct(
                        start.alias("start"), F.lit(kind).alias("kind"),
                        (start + F.length(match)).alias("end"), values[i].alias("value"))
                return F.transform(found, one)
            return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
                          if group else found, with_values)
        return _bound(F.split(text, pattern, -1), with_pieces)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    placed = _bound(matches, lambda m: F.when(F.size(m) > 0, place(m)))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    placed = F.coalesce(placed, none)
    return F.filter(placed, lambda s: F.length(s["value"]) >= least) if least else placed


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use)[0]


def _number() -> Column:
    """A small number from any 64-bit id, none of which may overflow what follows."""
    return F.pmod(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.lit(1_000_000_007))


def labelled_samples(docs: DataFrame, n_docs: int = SAMPLE_DOCS) -> DataFrame:
    """token, label: random strings (1) and ordinary identifiers (0).

    Taken from at most ``n_docs`` documents, the first in order of a hash. Digests
    of their ids, written in hex, base 36 and base 64, are random by construction;
    their words, alone, joined in the usual ways and with numbers, are identifiers.
    """
    # Stored, so that the table is sampled once and training has many tasks.
    chosen = store(
        sample(texts(docs), "doc_id", n_docs).repartition(SAMPLE_PARTS, "doc_id"), "secrets")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    random = chosen.select(F.explode(F.array(
        F.md5(name), F.sha1(name), F.base64(F.unhex(F.sha2(name, 256))),
        F.upper(F.sha1(F.concat(name, F.lit("u")))),
        F.concat(*[F.conv(F.substring(F.md5(F.concat(name, F.lit(k))), 1, 15), 16, 36)
                   for k in "xyz"]),
        F.translate(F.base64(F.unhex(F.sha2(F.concat(name, F.lit("w")), 256))), "+/=", "-_"),
    )).alias("token"), F.lit(1).alias("label"))
    words = F.regexp_extract_all("text", F.lit(r"[A-Za-z]{2,}"), F.lit(0))
    listed = chosen.select("doc_id", words.alias("w")).where(F.size("w") > 0)
    separators = F.array(*[F.lit(x) for x in ("_", "-", ".", "/", "", "=")])
    joined = F.transform(F.col("w"), lambda x, i: F.concat(
        x, separators[i % 6], F.coalesce(F.get(F.col("w"), i + 1), F.lit("")), separators[i % 6],
        F.when(i % 5 == 0, F.concat(F.lit("v"), ((i * 7 + _number()) % 1000).cast("string")))
        .when(i % 2 == 0, F.initcap(F.coalesce(F.get(F.col("w"), i + 2), F.lit(""))))
        .otherwise(F.upper(x))))
    ordinary = listed.select(F.explode(joined).alias("token"), F.lit(0).alias("label"))
    # Rules drawn with one character, dates, versions and plain numbers.
    number = _number()
    two = F.lpad((number % 28 + 1).cast("string"), 2, "0")
    year = (number % 40 + 1990).cast("string")
    plain = chosen.select(F.explode(F.array(
        F.repeat(F.substring(F.lit(ALPHABET), (number % len(ALPHABET) + 1).cast("int"), F.lit(1)),
                 F.lit(600)),
        F.concat_ws("-", year, two, two), F.concat_ws("/", year, two, two),
        F.concat_ws(".", (number % 9).cast("string"), two, (number % 13).cast("string")),
        F.concat((number * 7919 % 1000003).cast("string"), two, year),
    )).alias("token"), F.lit(0).alias("label"))
    return random.unionByName(ordinary).unionByName(plain)


def train(samples: DataFrame, alphabet: str = ALPHABET) -> list[float]:
    """The log-likelihood ratio of each step from one character to the next.

    A list of 128 x 128 entries by character codes; steps outside the alphabet,
    and every step when a class has no sample, are worth 0. Add-one smoothing.
    """
    token = F.col("token")
    steps = samples.where(F.length("token") > 1).select("label", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring(token, i, F.lit(2))
    )).alias("step"))
    inside = F.col("step").rlike("^[A-Za-z0-9+/_.=-]{2}$")
    counts = {(r["label"], r["step"]): r["count"]
              for r in steps.where(inside).groupBy("label", "step").count().collect()}
    table = [0.0] * (128 * 128)
    if {label for label, _ in counts} != {0, 1}:
        return table
    for a in alphabet:
        seen = [sum(counts.get((k, a + b), 0) for b in alphabet) + len(alphabet) for k in (0, 1)]
        for b in alphabet:
            odds = [math.log((counts.get((k, a + b), 0) + 1) / seen[k]) for k in (0, 1)]
            table[ord(a) * 128 + ord(b)] = round(odds[1] - odds[0], 6)
    return table


def ratio(token: Column, model: Column) -> Column:
    """The summed log-likelihood ratio of a token's steps."""
    def step(i: Column) -> Column:
        return model[F.ascii(F.substring(token, i, F.lit(1))) * 128
                     + F.ascii(F.substring(token, i + 1, F.lit(1)))]
    return F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda s, i: s + step(i))


def _without(token: Column, taken: Column) -> Column:
    """The token, or its pieces of sufficient length beside the spans ``taken``, which are
    in order of their starts and may overlap."""
    def piece(start: Column, end: Column) -> Column:
        return F.struct(
            start.alias("start"), token["kind"].alias("kind"), end.alias("end"),
            F.substring(token["value"], start - token["start"] + 1, end - start).alias("value"))

    def beside(upto: Column, end: Column) -> Column:
        none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
        return F.when(end - upto >= LEAST, F.array(piece(upto, end))).otherwise(none)

    start = F.struct(token["start"].alias("upto"), F.array().cast(
        "array<struct<start:int,kind:int,end:int,value:string>>").alias("found"))
    cut = F.aggregate(taken, start, lambda a, b: F.struct(
        F.greatest(a["upto"], b["end"]).alias("upto"),
        F.concat(a["found"], beside(a["upto"], b["start"])).alias("found")),
        lambda a: F.concat(a["found"], beside(a["upto"], token["end"])))
    return F.when(F.size(taken) == 0, F.array(token)).otherwise(cut)


def scan(docs: DataFrame, table: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text, base and extra spans of every document.

    ``base`` holds what the patterns find, ``extra`` what only the model reports:
    tokens, or what base spans leave of them, so the two never overlap. A null text
    is an empty one.
    """
    model = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    text = F.col("text")
    based = texts(docs).withColumns({
        "base": F.sort_array(F.concat(
            spans(text, ASSIGN, 0, group=2, least=ASSIGN_CHARS), spans(text, ACCESS, 1),
            spans(text, HEX, 2))),
        "tokens": spans(text, TOKEN, 3)})
    left = F.flatten(F.transform("tokens", lambda t: _without(t, F.filter(
        "base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))))
    extra = F.filter(left, lambda t: ratio(t["value"], model) >= threshold)
    return based.select("doc_id", "text", "base", extra.alias("extra"))


def _text(spans_: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: matches of each kind, the digest of base spans, all spans."""
    found = scan(docs, train(labelled_samples(docs)))

    def counted(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(
            f"n_{KINDS[kind]}")

    return found.select(
        "doc_id", counted(0), counted(1), counted(2),
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
        _text(F.sort_array(F.concat("base", "extra"))).alias("spans"))
