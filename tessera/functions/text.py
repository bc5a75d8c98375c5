"""Record-level text features: native Spark expressions, and for the counts one pass over the bytes of a batch of texts.

Java regexes are ASCII by default; ``(?U)`` turns on Unicode classes so that
``\\w``/``\\s`` behave like the Unicode-aware definitions the features use.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the features.
WORD_RE = r"(?U)\w+"                # a word for the nlp_* features
SPACE_RE = r"(?U)\s+"               # whitespace run (str.split semantics)
TOKEN_RE = r"(?U)\S+"               # a whitespace-separated token
SENTENCE_RE = r"(?U)[^.!?\s][^.!?]*"   # a sentence piece from its first non-space on
CLEAN_KEEP_RE = r"(?U)[^\w\s.,!?;:'\"()-]"   # characters removed by clean_text
CLEAN_MAX_CHARS = 10000
WORK_ID_RE = r"W\d+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_length(text) -> Column:
    """Length in code points; null → 0."""
    return F.coalesce(F.length(_c(text)), F.lit(0)).cast("long")


def has_text(text) -> Column:
    return (char_length(text) > 0).cast("int")


def whitespace_word_count(text) -> Column:
    """``len(str.split())``: whitespace-separated tokens (maximal non-space runs), empty/null → 0."""
    return F.coalesce(F.regexp_count(_c(text), F.lit(TOKEN_RE)), F.lit(0)).cast("long")


def regex_word_count(text) -> Column:
    """Number of runs of word characters."""
    return F.coalesce(F.regexp_count(_c(text), F.lit(WORD_RE)), F.lit(0)).cast("long")


def sentence_count(text) -> Column:
    """Pieces between ``[.!?]+`` that are not blank: one match per piece holding a non-space."""
    return F.coalesce(F.regexp_count(_c(text), F.lit(SENTENCE_RE)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- counts over whole texts
_SPACES, _DIGITS, _CAPITALS, _PUNCT = b" \t\n\v\f\r", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?"
_NON_WORDS = bytes(c for c in range(128) if not (chr(c).isalnum() or chr(c) == "_"))
_WORD_GAPS = bytes.maketrans(_NON_WORDS, b" " * len(_NON_WORDS))
_SENTENCE_ENDS = bytes.maketrans(b".!?", b"   ")
_WORD_KINDS = frozenset(("Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Mn", "Me", "Mc", "Pc"))
# letters by the Alphabetic property, though symbols by category, and the join controls
_OTHER_WORDS = [(0x200C, 0x200D), (0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189)]


class _Kinds(dict):
    """Code points beyond ASCII to an ASCII character of the same kind (those of ``(?U)\\w``, ``(?U)\\s``, ``\\p{Nd}``)."""

    def __missing__(self, c: int) -> str:
        kind = unicodedata.category(chr(c))
        if c < 128:
            to = chr(c)
        elif kind == "Nd":
            to = "0"
        elif kind in _WORD_KINDS or any(lo <= c <= hi for lo, hi in _OTHER_WORDS):
            to = "a"
        else:
            to = " " if kind in ("Zs", "Zl", "Zp") or c == 0x85 else "~"
        self[c] = to
        return to


_KINDS = _Kinds()


def _bytes(text: str) -> bytes:
    """One byte a code point."""
    return (text if text.isascii() else text.translate(_KINDS)).encode("ascii")


def _count_text(text: str) -> tuple[int, ...]:
    b = _bytes(text)
    spaced = b.translate(_WORD_GAPS)
    return (len(spaced.split()), len(b.translate(None, _NON_WORDS)),
            # blanks gone, what stands between separators is a sentence
            len(b.translate(_SENTENCE_ENDS, _SPACES).split()), len(b.translate(_SENTENCE_ENDS).split()),
            len(b) - len(b.translate(None, _CAPITALS)), len(b) - len(b.translate(None, _DIGITS)), len(b) - len(b.translate(None, _PUNCT)))


_COUNTS = ("words", "word_chars", "sentences", "sentence_words", "capitals", "digits", "punctuation")


def _text_counts(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_count_text(t) for t in text], columns=list(_COUNTS))


def _token_counts(text: pd.Series) -> pd.Series:
    return pd.Series([len(_bytes(t).split()) for t in text], dtype="int64")


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def nlp_features(text) -> list[Column]:
    """F23-F25 on one text column; returns aliased columns.

    nlp_char_count, nlp_word_count, nlp_avg_word_length, nlp_sentence_count,
    nlp_avg_sentence_length, nlp_capital_ratio, nlp_number_ratio,
    nlp_punctuation_ratio. Null/empty text gives zeros.
    """
    t = F.coalesce(_c(text), F.lit(""))
    chars = F.length(t).cast("long")
    n = F.pandas_udf(_text_counts, ", ".join(f"{c} long" for c in _COUNTS))(t)
    # every word character lies in exactly one maximal word run; words of the kept sentences are runs of characters
    # that are neither blank nor separators
    return [
        chars.alias("nlp_char_count"),
        n["words"].alias("nlp_word_count"),
        _ratio(n["word_chars"], n["words"]).alias("nlp_avg_word_length"),
        n["sentences"].alias("nlp_sentence_count"),
        _ratio(n["sentence_words"], n["sentences"]).alias("nlp_avg_sentence_length"),
        _ratio(n["capitals"], chars).alias("nlp_capital_ratio"),
        _ratio(n["digits"], chars).alias("nlp_number_ratio"),
        _ratio(n["punctuation"], chars).alias("nlp_punctuation_ratio"),
    ]


def title_abstract_features(title, abstract) -> list[Column]:
    """Lengths, has_abstract, whitespace word counts."""
    tokens = F.pandas_udf(_token_counts, "long")
    return [
        char_length(title).alias("title_length"),
        char_length(abstract).alias("abstract_length"),
        has_text(abstract).alias("has_abstract"),
        tokens(F.coalesce(_c(title), F.lit(""))).alias("title_word_count"),
        tokens(F.coalesce(_c(abstract), F.lit(""))).alias("abstract_word_count"),
    ]


def combined_text(title, abstract) -> Column:
    """``"{title} {abstract}"`` with missing parts as empty strings."""
    return F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "), F.coalesce(_c(abstract), F.lit("")))


def clean_text(text, max_chars: int | None = None) -> Column:
    """collapse whitespace, drop unusual characters, trim.

    The whole text is kept by default; ``max_chars=CLEAN_MAX_CHARS`` reproduces the
    reference's cut (first 10,000 characters + "...") for models with an input limit.
    """
    t = F.regexp_replace(F.regexp_replace(_c(text), SPACE_RE, " "), CLEAN_KEEP_RE, "")
    cut = t if max_chars is None else \
        F.when(F.length(t) > max_chars, F.concat(F.substring(t, 1, max_chars), F.lit("..."))).otherwise(t)
    # Python's strip() removes any whitespace; after collapsing only ' ' can remain at the ends
    out = F.regexp_replace(cut, r"^(?U)\s+|(?U)\s+$", "")
    return F.when(_c(text).isNull() | (_c(text) == ""), F.lit("")).otherwise(out)


def embedding_text(title, abstract, max_chars: int | None = None) -> Column:
    """``"{title}. {abstract}"`` when there is an abstract, else the title; then cleaned."""
    a = _c(abstract)
    raw = F.when(a.isNotNull() & (a != ""), F.concat(F.coalesce(_c(title), F.lit("")), F.lit(". "), a)) \
        .otherwise(F.coalesce(_c(title), F.lit("")))
    return clean_text(raw, max_chars)


def work_id(id_col) -> Column:
    """keep ``W…`` without '/', else first ``W\\d+``, else the value unchanged."""
    s = _c(id_col).cast("string")
    found = F.regexp_extract(s, WORK_ID_RE, 0)
    return (F.when(s.startswith("W") & (F.length(s) > 1) & ~s.contains("/"), s)
            .when(found != "", found)
            .otherwise(s))


def first_line(text) -> Column:
    """Title of a document: its first line."""
    return F.split_part(_c(text), F.lit("\n"), F.lit(1))


def after_first_line(text) -> Column:
    """Abstract of a document: everything after the first line, null when empty."""
    t = _c(text)
    rest = F.substr(t, F.length(first_line(t)) + 2)
    return F.when(rest == "", F.lit(None).cast("string")).otherwise(rest)
