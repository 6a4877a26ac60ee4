"""Column-level text helpers (all built-in expressions, whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on.
# A term is a maximal run of Unicode letters and digits, lower-cased.
TERM_PATTERN = r"[\p{L}\p{N}]+"
# A sentence is a run of characters that are not sentence ends, followed by
# any sentence-end punctuation. Delimiters: . ! ? and line break.
SENTENCE_DELIMITERS = ".!?\n"
# Whitespace removed by Python's str.strip() in the reference's batch mode.
STRIP_CLASS = r"[ \t\n\r\f\x0B]"
SEP_MARK = " [SEP] "


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def terms(text) -> Column:
    """ARRAY<STRING> of lower-cased terms; NULL text gives NULL."""
    return F.regexp_extract_all(F.lower(col_(text)), F.lit(TERM_PATTERN), 0)


def term_text(text) -> Column:
    """The lower-cased text with a blank for each character beyond ASCII that no term has, so that ``terms``
    are its runs of ASCII letters, digits and characters beyond ASCII; NULL text gives NULL. Only texts
    with characters beyond ASCII meet a regular expression."""
    low = F.lower(col_(text))
    beyond = TERM_PATTERN.replace("[", r"[^\x00-\x7F", 1).removesuffix("+")
    return F.when(F.octet_length(low) > F.char_length(low), F.regexp_replace(low, beyond, " ")).otherwise(low)


def _class_escape(chars: str) -> str:
    out = []
    for ch in chars:
        if ch == "\n":
            out.append("\\n")
        elif ch in "\\]^-[":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def sentence_pattern(delimiters: str = SENTENCE_DELIMITERS) -> str:
    """Regex for one sentence given the delimiter set."""
    ends = "".join(ch for ch in delimiters if ch != "\n")
    body = "[^" + _class_escape(delimiters) + "]+"
    return body + ("[" + _class_escape(ends) + "]*" if ends else "")


def split_sentences(text, delimiters: str = SENTENCE_DELIMITERS) -> Column:
    """ARRAY<STRING> of sentences, not stripped.

    Empty or NULL text gives an empty array; text with no sentence in it is
    returned whole as the only sentence.
    """
    t = col_(text)
    found = F.regexp_extract_all(t, F.lit(sentence_pattern(delimiters)), 0)
    return (F.when(F.coalesce(t, F.lit("")) == "", F.array().cast("array<string>"))
            .when(F.size(found) == 0, F.array(t))
            .otherwise(found))


def py_strip(c) -> Column:
    """Python ``str.strip()`` on the ASCII whitespace set."""
    return F.regexp_replace(col_(c), "^" + STRIP_CLASS + "+|" + STRIP_CLASS + "+$", "")


def md5_bucket(c, hex_digits: int = 8) -> Column:
    """Unsigned integer from the first hex digits of md5 (same in DuckDB)."""
    return F.conv(F.substring(F.md5(col_(c).cast("string")), 1, hex_digits), 16, 10) \
        .cast("bigint")


def pair_text(prompt, sentence) -> Column:
    """``prompt [SEP] sentence``; NULL if either side is NULL."""
    return F.concat(col_(prompt), F.lit(SEP_MARK), col_(sentence))
