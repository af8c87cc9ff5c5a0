"""Fill-in-the-middle: documents cut into prefix, middle and suffix by one counted match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import text_of

LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100  # percent of the documents that are cut
SPM_RATE = 50  # percent of the cut ones whose suffix comes first


def draws(id_col: str | Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits out of the SHA-256 of the seed and the id; a null id is empty."""
    key = F.coalesce((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = LINE,
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """Rows ``id, n, form, prefix_chars, middle_chars, output``, one per document, over whole texts.

    ``n`` units are counted with ``regexp_count``. Two drawn numbers cut them at ``a <= b``, and the
    row's own pattern ``(unit{a}+)(unit{b-a}+)(rest)`` finds the three parts in one match, whose
    replacement writes them in the order of the form: ``psm``, prefix, suffix, middle, or ``spm``,
    suffix, prefix, middle, each after its marker. A text that is empty or holds a marker, and one
    that the rate leaves out, stays ``plain`` as it is, with null lengths. ``unit`` is a Java
    pattern without capturing groups that matches one unit at the place where the last one ended;
    together its matches cover the text.

    The counts are possessive and the rest is anchored, so the matcher never goes back: time is
    linear in the text and no stack grows with it, for texts of any number of megabytes. Two to
    three copies of one text are in memory at a time, and while they are counted its units as separate strings. Null texts count as empty, null ids as an
    empty id; repeated rows are transformed alike, each on its own; no column but the two is read.
    There is no shuffle and nothing is drawn at random, so a repeated task gives the same rows.
    """
    h1, h2, h3, h4 = draws("id", seed)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(F.col(f"`{text_col}`")).alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long"))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    plain = (F.col("text") == "") | marked | (h3 % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm"))
    rows = rows.withColumn("_one", h1 % (F.col("n") + 1)).withColumn("_two", h2 % (F.col("n") + 1))

    def part(count: Column) -> Column:
        return F.concat(F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)"))

    low, high = F.least("_one", "_two"), F.greatest("_one", "_two")
    pattern = F.concat(F.lit(r"\A"), part(low), part(high - low), F.lit(r"((?s:.*+))\z"))
    psm, spm = f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"
    order = F.when(F.col("form") == "psm", psm).otherwise(spm)
    cut = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    rows = rows.withColumn("output", cut)
    # no marker is in the text, so the places of the markers tell the lengths
    at = {m: F.locate(m, F.col("output")) for m in (PREFIX, SUFFIX, MIDDLE)}
    after = F.when(F.col("form") == "psm", at[SUFFIX]).when(F.col("form") == "spm", at[MIDDLE])
    middle = F.when(F.col("form") != "plain", F.length("output") - at[MIDDLE] + 1 - len(MIDDLE))
    return rows.select(
        "id", "n", "form",
        (after - at[PREFIX] - len(PREFIX)).cast("long").alias("prefix_chars"),
        middle.cast("long").alias("middle_chars"),
        "output",
    )


def restore(output: str | Column, form: str | Column) -> Column:
    """The text that an output of a form was made from: null if either is null."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    any_text = "((?s:.*?))"
    psm = rf"\A{PREFIX}{any_text}{SUFFIX}{any_text}{MIDDLE}((?s:.*+))\z"
    spm = rf"\A{SUFFIX}{any_text}{PREFIX}{any_text}{MIDDLE}((?s:.*+))\z"
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.regexp_replace(output, psm, "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, spm, "$2$3$1"))
    )
