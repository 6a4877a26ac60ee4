"""Fill-in-middle transformation by one regular expression match a text.

A text is a sequence of n units (a word with the white space before it, or the white space at the
end). Two cut points a <= b, drawn from the document's id, split it into prefix, middle and suffix,
which are written in suffix order with marks between them. ``regexp_count`` gives n; the row's own
pattern ``(unit{a})(unit{b-a})(rest)``, with possessive quantifiers, captures the three parts in one
match, and the replacement string of the row's form puts them in place. Possessive groups are what
makes this safe: they keep no backtracking state, so a match runs in a loop and a text of any length
needs no stack.

Everything is row-local SQL functions: no shuffle, no Python, work in proportion to the text.

Defined results: a null text is an empty one (``n`` 0, form ``plain``); a null id draws as an empty
id; rows with equal ids draw alike, so repeated rows give repeated results; a text that holds one of
the marks stays ``plain``, so that a transformed text can always be taken apart again; very long
texts are matched whole. Columns of the input never clash: they are packed in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import pack

# White space, a unit, the marks, and the pattern that takes an output apart.
SPACE = r"\x20\x09-\x0D"
UNIT = rf"(?:[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED, RATE, SPM_RATE = 42, 50, 80


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def cut_pattern(a: Column, b: Column) -> Column:
    """The row's pattern: ``a`` units, ``b - a`` units, the rest. Anchored, so there is one match."""
    return F.concat(F.lit(rf"(?s)\A({UNIT}{{"), a.cast("string"), F.lit(rf"}}+)({UNIT}{{"), (b - a).cast("string"), F.lit(r"}+)(.*+)\z"))


def restore(output: Column, form: Column) -> Column:
    """The original text of an output."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1")
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``row`` (a struct of the input's columns), doc_id, n, form, prefix_chars, middle_chars and
    ``output`` of every row. ``rate`` of 100 documents are transformed, ``spm_rate`` of 100 of them
    with the suffix first."""
    row = pack(docs, "row")
    rows = row.select("row", F.col(f"row.`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"row.`{text}`"), F.lit("")).alias("t"))
    rows = rows.withColumn("n", F.regexp_count("t", F.lit(UNIT)).cast("long")).withColumn("h", F.array(*draws(F.col("doc_id"), seed)))
    h = [F.element_at("h", i) for i in (1, 2, 3, 4)]
    cuts = [h[i] % (F.col("n") + 1) for i in (0, 1)]
    marked = F.contains("t", F.lit(PREFIX)) | F.contains("t", F.lit(SUFFIX)) | F.contains("t", F.lit(MIDDLE))
    plain = (F.col("t") == "") | marked | (h[2] % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, PLAIN).when(h[3] % 100 < spm_rate, SPM).otherwise(PSM))
    order = F.when(F.col("form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    cut = F.regexp_replace("t", cut_pattern(F.least(*cuts), F.greatest(*cuts)), order)
    out = rows.select("row", "doc_id", "n", "form", F.when(F.col("form") == PLAIN, F.col("t")).otherwise(cut).alias("output"))
    at = {m: F.locate(m, F.col("output")) for m in (PREFIX, SUFFIX, MIDDLE)}  # no mark is in a transformed text
    prefix = F.when(F.col("form") == PSM, at[SUFFIX] - 1).when(F.col("form") == SPM, at[MIDDLE] - at[PREFIX]) - len(PREFIX)
    middle = F.when(F.col("form") != PLAIN, F.length("output") - at[MIDDLE] - len(MIDDLE) + 1)
    return out.select("row", "doc_id", "n", "form", prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"), "output")


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored text."""
    back = restore(F.col("output"), F.col("form"))
    return transform(docs, **options).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                                             F.sha2(back.cast("binary"), 256).alias("restored_sha256"))
