"""Fill-in-middle: texts cut into prefix, middle and suffix and put in another order.

``regexp_count`` gives the number of units of a text, by blocks and then one by one
in what the blocks leave, as it holds all its matches. A pattern made for the row
takes the prefix as ``unit{a}+``, the middle as ``unit{b-a}+`` and the rest, each
possessive, so one pass without backtracking captures all three, and the
replacement puts them in their new places in that same match. Nothing is shuffled
and no Python runs.

Draws come from a hash of a seed and the document's id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands before prefix, suffix and middle. None may be part of another.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, those that are cut, and of a hundred cut ones, those suffix first.
CUT, SUFFIX_FIRST = 90, 20
#: One code point, line ends included.
UNIT = "."
#: Units that are counted in one match.
BLOCK = 1_000


def _draws(seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and doc_id (null: no digits)."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"),
                                                           F.lit(""))), 256)
    return [F.conv(F.substring(hashed, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _count(text: Column, unit: str) -> Column:
    """How many units follow each other from the start of the text."""
    block = f"(?:{unit}){{{BLOCK}}}+"
    rest = F.regexp_replace(text, f"(?s)\\A(?:{block})*+", "")
    return (F.regexp_count(text, F.lit(f"(?s)\\G{block}")).cast("bigint") * BLOCK
            + F.regexp_count(rest, F.lit(f"(?s)\\G(?:{unit})")))


def _quoted(text: str) -> str:
    """A replacement that stands for itself."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def transform(
    docs: DataFrame,
    seed: int = 1,
    unit: str = UNIT,
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """doc_id and text, then n, form, prefix_units, middle_units and output.

    ``unit`` is a pattern (dot meets line ends) that matches a text from its start
    piece by piece; what it leaves over goes to the suffix. A text is ``plain``, its
    own output, if it has no unit, holds one of the marks or is not drawn. A null
    text is an empty one. Only doc_id and text are read; rows that repeat come out
    alike, and rows with a null doc_id share one draw.
    """
    p, s, m = marks
    one, other, drawn, turned = _draws(seed)
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Read once each: later columns name these instead of repeating their work.
    counted = base.withColumns({
        "n": _count(F.col("text"), unit),
        "__marked": F.contains("text", F.lit(p)) | F.contains("text", F.lit(s))
        | F.contains("text", F.lit(m)),
    })
    a, b = F.pmod(one, F.col("n") + 1), F.pmod(other, F.col("n") + 1)
    placed = counted.withColumns({
        "form": F.when((F.col("n") == 0) | F.col("__marked") | (drawn % 100 >= cut), "plain")
        .when(turned % 100 < suffix_first, "spm").otherwise("psm"),
        "__a": F.least(a, b),
        "__b": F.greatest(a, b),
    })
    whole = f"(?:{unit})" if len(unit) > 1 else unit
    pattern = F.concat(
        F.lit(f"(?s)\\A({whole}{{"), F.col("__a"), F.lit(f"}}+)({whole}{{"),
        F.col("__b") - F.col("__a"), F.lit("}+)(.*+)"))
    psm, spm = (f"{_quoted(p)}$1{_quoted(s)}$3{_quoted(m)}$2",
                f"{_quoted(s)}$3{_quoted(p)}$1{_quoted(m)}$2")
    is_plain = F.col("form") == "plain"
    return placed.select(
        "doc_id", "text", "n", "form",
        F.when(~is_plain, F.col("__a")).alias("prefix_units"),
        F.when(~is_plain, F.col("__b") - F.col("__a")).alias("middle_units"),
        F.when(is_plain, F.col("text")).otherwise(
            F.regexp_replace(F.col("text"), pattern, F.when(F.col("form") == "spm", spm)
                             .otherwise(psm))).alias("output"),
    )


def restore(
    output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)
) -> Column:
    """The text again. A cut text held no mark, so each mark's first place is its own."""
    p, s, m = (f"\\Q{x}\\E" for x in marks)
    psm = F.regexp_replace(output, f"(?s)\\A{p}(.*?){s}(.*?){m}(.*+)", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)\\A{s}(.*?){p}(.*?){m}(.*+)", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(docs: DataFrame) -> DataFrame:
    """Form, lengths, and digests of the output and of the text rebuilt from it."""
    return transform(docs).select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
