"""Fill-in-middle by counted quantifiers of a regular expression, on SQL functions only.

``regexp_count`` gives the number n of units of a text: code points, or whatever pattern is given. Two
cuts a <= b of 0..n follow from a hash of the id. The row's own pattern has the possessive groups
``(unit{a}+)``, ``(unit{b-a}+)`` and the rest; one match of it, which cannot backtrack, captures prefix,
middle and suffix and writes them in the order of the form:

* psm ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* spm ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* plain: the text as it is

A text that holds a marker stays plain, so a marked text has each marker once and can be restored. Every
row is cut in its own scan: nothing is shuffled.

Units must tile the text from its start; what lies behind the last unit belongs to the suffix. They are
counted in blocks of ``BLOCK`` first, so that a long text makes no array of all its units. A task holds
the text and its output a few times over as UTF-16, some ten times the bytes of its longest text.

Defined cases: null and empty texts are plain, of no unit, with an empty output. A null id counts as the
empty text in the hash. Rows of equal id have the same hashes; repeated rows come back as often as they
are given. Only the id and the text are read, so other columns may have any name. An empty table gives
an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_POINT = "(?s:.)"
BLOCK = 4096
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SEED = "1:"

# The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# The forms' outputs, as replacements of the groups prefix 1, middle 2 and suffix 3.
ORDERS = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def unit_count(text: Column, unit: str = CODE_POINT) -> Column:
    """The number of units that tile a text: full blocks, then the units behind them."""
    blocks = F.regexp_count(text, F.lit(f"(?:{unit}){{{BLOCK}}}+"))
    full = F.concat(F.lit(f"^(?:{unit}){{"), (blocks * BLOCK).cast("string"), F.lit("}+"))
    behind = F.when(blocks > 0, F.regexp_replace(text, full, F.lit(""))).otherwise(text)
    return (blocks * BLOCK + F.regexp_count(behind, F.lit(unit))).cast("long")


def hash_number(digest: Column, number: int) -> Column:
    """The unsigned integer in group ``number``, from 1, of eight hex digits."""
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def cut_once(text: Column, a: Column, b: Column, order: Column, unit: str = CODE_POINT) -> Column:
    """The text with its three parts in the given order: one match of the row's own pattern."""
    group = f"((?:{unit}){{"
    pattern = F.concat(
        F.lit(f"^{group}"), a.cast("string"), F.lit(f"}}+){group}"), (b - a).cast("string"), F.lit("}+)((?s:.*+))\\z")
    )
    return F.regexp_replace(text, pattern, order)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made of."""
    psm = f"^{PREFIX}((?s:.*?)){SUFFIX}((?s:.*?)){MIDDLE}((?s:.*+))\\z"
    spm = f"^{SUFFIX}((?s:.*?)){PREFIX}((?s:.*?)){MIDDLE}((?s:.*+))\\z"
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, spm, "$2$3$1"))
        .otherwise(output)
    )


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = CODE_POINT,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """One row per input row: doc_id, n, form, prefix_chars, middle_chars, output."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    text = F.col("_text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (F.col("_h3") % 100 >= 100 - plain_percent)
    one, two = F.col("_h1") % (F.col("n") + 1), F.col("_h2") % (F.col("n") + 1)
    order = F.when(F.col("form") == "spm", F.lit(ORDERS["spm"])).otherwise(F.lit(ORDERS["psm"]))
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    hashed = docs.select("*", digest.alias("_digest"), unit_count(text, unit).alias("n"))
    hashed = hashed.select("doc_id", "_text", "n", *[hash_number(F.col("_digest"), i).alias(f"_h{i}") for i in (1, 2, 3, 4)])
    form = F.when(plain, F.lit("plain")).when(F.col("_h4") % 100 < spm_percent, F.lit("spm")).otherwise(F.lit("psm"))
    formed = hashed.select("doc_id", "_text", "n", form.alias("form"), F.least(one, two).alias("_a"), F.greatest(one, two).alias("_b"))
    cut = cut_once(text, F.col("_a"), F.col("_b"), order, unit)
    made = formed.select("*", F.when(F.col("form") == "plain", text).otherwise(cut).alias("output"))
    part = F.split("output", f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    moved = F.col("form") != "plain"
    prefix = F.get(part, F.when(F.col("form") == "psm", F.lit(1)).otherwise(F.lit(2)))
    prefix_chars, middle_chars = F.char_length(prefix), F.char_length(F.get(part, F.lit(3)))
    if unit == CODE_POINT:
        prefix_chars, middle_chars = F.col("_a"), F.col("_b") - F.col("_a")
    return made.select(
        "doc_id", "n", "form",
        F.when(moved, prefix_chars.cast("long")).alias("prefix_chars"),
        F.when(moved, middle_chars.cast("long")).alias("middle_chars"),
        "output",
    )
