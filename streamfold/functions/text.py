"""Text normalisation, masking and letter-run segmentation (FN-02..FN-07).

Fixed values that must equal the reference's behaviour:

* a "word" is a maximal run of Unicode letters, ``\\p{L}+``; everything
  else is copied through unchanged;
* dictionary words are trimmed of all Unicode white space, then
  lower-cased;
* the mask of a word is ``*`` repeated once per code point.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
LETTER_RUN = r"\p{L}+"
# One alternation that tiles any string: letter runs and the gaps between them.
SEGMENTS = r"(\p{L}+|[^\p{L}]+)"
# Leading/trailing white space: exactly the Unicode White_Space set
# (ASCII controls \t..\r, NEL, and the separator categories Z*).
EDGE_SPACE = r"^[\t\n\x{0B}\f\r\x{85}\p{Z}]+|[\t\n\x{0B}\f\r\x{85}\p{Z}]+$"
MASK_CHAR = "*"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def unicode_trim(col) -> Column:
    """Trim every kind of Unicode white space from both ends (Q7)."""
    return F.regexp_replace(_c(col), EDGE_SPACE, "")


def normalize_word(col) -> Column:
    """FN-03: trim, then lower-case."""
    return F.lower(unicode_trim(col))


def word_mask(col) -> Column:
    """FN-04: one ``*`` per code point of the (normalised) word."""
    return F.repeat(F.lit(MASK_CHAR), F.char_length(_c(col)))


def segments(col) -> Column:
    """Split text into alternating letter runs and non-letter gaps.

    ``array_join(segments(t), '')`` gives back ``t`` exactly.
    """
    return F.regexp_extract_all(_c(col), F.lit(SEGMENTS), 1)


def is_letter_run(col) -> Column:
    return _c(col).rlike("^" + LETTER_RUN + r"\z")


def word_buckets(words: Column) -> Column:
    """``words`` (an array) as about sqrt(n) strings by hash, each with a
    blank before and after every word: what ``mask_words`` looks into."""
    n = F.ceil(F.sqrt(F.size(words))).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.concat(F.lit(" "), F.array_join(F.filter(
        words, lambda w: F.pmod(F.hash(w), n) == b), " "), F.lit(" ")))


def mask_words(text: Column, buckets: Column) -> Column:
    """FN-06: letter runs of ``text`` whose lower-case form is in ``buckets``
    (``word_buckets``) become their mask (FN-04); everything else is copied.
    A word has no blank, so a search for `` word `` in its bucket is exact."""
    def listed(w: Column) -> Column:
        bucket = F.get(buckets, F.pmod(F.hash(w), F.size(buckets)))
        return F.contains(bucket, F.concat(F.lit(" "), w, F.lit(" ")))
    return mask_words_if(text, listed)


def mask_words_if(text: Column, listed: Callable[[Column], Column]) -> Column:
    """FN-06: letter runs whose lower-case form is ``listed`` become their
    mask; everything else is copied."""
    cut = segments(text)
    # Each run is lower-cased once: a lambda would do it anew for every use.
    return F.array_join(F.zip_with(cut, F.transform(cut, F.lower),
                                   lambda s, w: F.when(listed(w), word_mask(w)).otherwise(s)), "")


GAP = 64            # code points between two special characters of one searched range


@lru_cache(maxsize=1)
def _special_upper_table() -> tuple[str, str, str]:
    """Characters whose full upper-case form is longer than one code point,
    and their simple upper form.

    Spark's ``upper`` applies the full (SpecialCasing) mapping, e.g.
    ``ß`` -> ``SS``; the reference upper-cases rune by rune with the simple
    mapping, which keeps such a character or maps it to its single-code-point
    title case.  The table is derived from Python's Unicode database by that
    rule.  Third, a class of a few ranges that hold them all: to search it
    is cheaper than to search for each.
    """
    src, dst = [], []
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        if len(ch.upper()) > 1:
            title = ch.title()
            src.append(ch)
            dst.append(title if len(title) == 1 else ch)
    ranges: list[list[int]] = []
    for cp in map(ord, src):
        if ranges and cp - ranges[-1][1] <= GAP:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return "".join(src), "".join(dst), "[" + "".join("\\x{%X}-\\x{%X}" % (a, z) for a, z in ranges) + "]"


def rune_upper(col) -> Column:
    """FN-02: upper-case with the per-code-point simple mapping.  Runs of
    special characters are mapped by table, everything else by ``upper``."""
    src, dst, near = _special_upper_table()
    c, special = _c(col), "[" + src + "]"
    runs = F.regexp_extract_all(c, F.lit(f"({special}+|[^{src}]+)"), 1)
    slow = F.array_join(F.transform(
        runs, lambda r: F.when(r.rlike(special), F.translate(r, src, dst)).otherwise(F.upper(r))), "")
    return F.when(c.rlike(near) & c.rlike(special), slow).otherwise(F.upper(c))
