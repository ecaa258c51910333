"""String functions (inventory F1-F21).

Scalar Python string exercises are re-aimed at whole text columns: each
helper is a Catalyst expression that works on every row of a column,
whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions._util import as_col, lit_or_col

# The vowel set used by the vowel/consonant exercises.
VOWELS = "aeiouAEIOU"
# ASCII consonants (letters that are not vowels).
CONSONANT_CLASS = "[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]"


def _quote(s: str) -> str:
    """Regex-quote a literal for Java regex."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


# F1 ---------------------------------------------------------------------
def upper(c) -> Column:
    return F.upper(as_col(c))


def lower(c) -> Column:
    return F.lower(as_col(c))


def length(c) -> Column:
    return F.length(as_col(c))


# F2 / F3 ----------------------------------------------------------------
def initcap(c) -> Column:
    """Spark/SQL initcap: upper-cases the first letter after whitespace."""
    return F.initcap(as_col(c))


def title_case(c) -> Column:
    """Python ``str.title``: a letter is upper-cased when the previous
    character is not a letter (so ``data-science`` -> ``Data-Science``),
    every other letter is lower-cased."""
    chars = F.split(as_col(c), "")
    return F.array_join(F.transform(chars, lambda ch, i: F.when(
        (i == 0) | ~F.element_at(chars, i).rlike("^\\p{L}$"), F.upper(ch)
    ).otherwise(F.lower(ch))), "")


def capitalize(c) -> Column:
    """Python ``str.capitalize``: first character upper, rest lower."""
    c = as_col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))


# F4 ---------------------------------------------------------------------
def strip(c, chars: str | None = None) -> Column:
    """Python ``strip``: whitespace by default, else the given characters."""
    c = as_col(c)
    if chars is None:
        return F.regexp_replace(c, "^\\s+|\\s+$", "")
    return F.btrim(c, F.lit(chars))


def lstrip(c, chars: str | None = None) -> Column:
    c = as_col(c)
    if chars is None:
        return F.regexp_replace(c, "^\\s+", "")
    return F.regexp_replace(c, "^[" + _class(chars) + "]+", "")


def rstrip(c, chars: str | None = None) -> Column:
    c = as_col(c)
    if chars is None:
        return F.regexp_replace(c, "\\s+$", "")
    return F.regexp_replace(c, "[" + _class(chars) + "]+$", "")


def _class(chars: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in chars)



# F5 ---------------------------------------------------------------------
def split_words(c) -> Column:
    """Python no-argument ``split()``: runs of whitespace separate words,
    leading/trailing whitespace yields no empty words. (One split pass;
    the empty strings produced at the ends are filtered out.)"""
    return F.filter(F.split(as_col(c), "\\s+"), lambda w: w != "")


def split_part(c, delimiter: str, index: int, limit: int = -1) -> Column:
    """Element ``index`` (0-based, negative from the end) of a literal split;
    NULL when out of range."""
    parts = F.split(as_col(c), _quote(delimiter), limit)
    pos = index + 1 if index >= 0 else index
    need = index + 1 if index >= 0 else -index
    return F.when(F.size(parts) >= need, F.element_at(parts, F.lit(pos)))


# F6 ---------------------------------------------------------------------
def concat(*cols) -> Column:
    """SQL concat: any NULL input makes the result NULL."""
    return F.concat(*[lit_or_col(c) if not isinstance(c, str) else F.col(c) for c in cols])


def concat_ws(sep: str, *cols) -> Column:
    """Join with a separator, skipping NULLs."""
    return F.concat_ws(sep, *[as_col(c) for c in cols])


def join_array(arr, sep: str) -> Column:
    return F.array_join(as_col(arr), sep)


# F7 ---------------------------------------------------------------------
def lpad(c, width: int, fill: str = " ") -> Column:
    return F.lpad(as_col(c), width, fill)


def rpad(c, width: int, fill: str = " ") -> Column:
    return F.rpad(as_col(c), width, fill)


def pad_left_no_truncate(c, width: int, fill: str = " ") -> Column:
    """pandas ``str.pad``: pads short strings, leaves longer ones whole."""
    c = as_col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, fill))


# F8 ---------------------------------------------------------------------
def replace_all(c, old: str, new: str) -> Column:
    return F.replace(as_col(c), F.lit(old), F.lit(new))


def replace_first(c, old: str, new: str, count: int = 1) -> Column:
    """Python ``str.replace(old, new, count)``."""
    parts = F.split(as_col(c), _quote(old), count + 1)
    return F.array_join(parts, new)


def regex_replace(c, pattern: str, repl: str) -> Column:
    return F.regexp_replace(as_col(c), pattern, repl)


# F9 ---------------------------------------------------------------------
def substring(c, start: int, length_: int) -> Column:
    """1-based SQL substring."""
    return F.substring(as_col(c), start, length_)


def py_slice(c, start: int | None = None, stop: int | None = None) -> Column:
    """Python ``s[start:stop]`` with negative indexes."""
    c = as_col(c)
    n = F.length(c)

    def norm(i, default):
        if i is None:
            return default
        if i >= 0:
            return F.least(F.lit(i), n)
        return F.greatest(n + F.lit(i), F.lit(0))

    s = norm(start, F.lit(0))
    e = norm(stop, n)
    return F.when(e > s, F.substring(c, s + 1, e - s)).otherwise(F.lit(""))


def left(c, n: int) -> Column:
    return F.left(as_col(c), F.lit(n))


def right(c, n: int) -> Column:
    return F.right(as_col(c), F.lit(n))


# F10 --------------------------------------------------------------------
def find(c, sub: str) -> Column:
    """Python ``str.find``: 0-based position, -1 when missing."""
    return F.locate(sub, as_col(c)) - 1


def all_positions(c, sub: str) -> Column:
    """All 0-based start positions of ``sub`` (overlapping), in order."""
    c = as_col(c)
    n = F.length(c) - len(sub) + 1
    idx = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    hits = F.filter(idx, lambda i: F.substring(c, i, len(sub)) == sub)
    return F.when(n >= 1, F.transform(hits, lambda i: i - 1)).otherwise(F.array().cast("array<int>"))


# F11 --------------------------------------------------------------------
def count_substring(c, sub: str) -> Column:
    """Non-overlapping occurrences (pandas ``str.count`` of a literal)."""
    return F.regexp_count(as_col(c), F.lit(_quote(sub)))


# F12 --------------------------------------------------------------------
def reverse(c) -> Column:
    return F.reverse(as_col(c))


def reverse_words(c) -> Column:
    return F.array_join(F.reverse(split_words(c)), " ")


# F13 --------------------------------------------------------------------
def remove_chars(c, chars: str) -> Column:
    return F.translate(as_col(c), chars, "")


def remove_vowels(c) -> Column:
    return remove_chars(c, VOWELS)


def remove_punctuation(c) -> Column:
    """Drop every character that is neither a word character nor space."""
    return F.regexp_replace(as_col(c), "(?U)[^\\w\\s]", "")


# F14 --------------------------------------------------------------------
def word_count(c) -> Column:
    return F.size(split_words(c))


def longest_word(c) -> Column:
    """First word of maximal length (Python ``max(words, key=len)``)."""
    words = split_words(c)
    best = F.array_max(F.transform(words, lambda w, i: F.struct(
        F.length(w).alias("l"), (-i).alias("p"), w.alias("w"))))
    return best["w"]


def shortest_word(c) -> Column:
    words = split_words(c)
    best = F.array_min(F.transform(words, lambda w, i: F.struct(
        F.length(w).alias("l"), i.alias("p"), w.alias("w"))))
    return best["w"]


def words_starting_with(c, prefix: str, ignore_case: bool = False) -> Column:
    words = split_words(c)
    if ignore_case:
        return F.filter(words, lambda w: F.startswith(F.lower(w), F.lit(prefix.lower())))
    return F.filter(words, lambda w: F.startswith(w, F.lit(prefix)))


# F15 --------------------------------------------------------------------
def _count_class(c, negated_class: str) -> Column:
    """Characters of a class, counted as the length left after deleting
    runs of the complement (fewer regex matches than one per character)."""
    return F.length(F.regexp_replace(as_col(c), negated_class + "+", ""))


def count_letters(c) -> Column:
    return _count_class(c, "\\P{L}")


def count_digits(c) -> Column:
    return _count_class(c, "\\P{Nd}")


def count_spaces(c) -> Column:
    return F.regexp_count(as_col(c), F.lit("\\s"))


def count_specials(c) -> Column:
    """Characters that are not letters, digits or whitespace."""
    return F.regexp_count(as_col(c), F.lit("[^\\p{L}\\p{Nd}\\s]"))


def count_upper(c) -> Column:
    return _count_class(c, "\\P{Lu}")


def count_lower(c) -> Column:
    return _count_class(c, "\\P{Ll}")


def count_vowels(c) -> Column:
    return F.regexp_count(as_col(c), F.lit("[" + VOWELS + "]"))


def count_consonants(c) -> Column:
    return F.regexp_count(as_col(c), F.lit(CONSONANT_CLASS))


# F16 --------------------------------------------------------------------
def is_digit(c) -> Column:
    return as_col(c).rlike("^\\p{Nd}+$")


def is_alpha(c) -> Column:
    return as_col(c).rlike("^\\p{L}+$")


def is_alnum(c) -> Column:
    return as_col(c).rlike("^[\\p{L}\\p{Nd}]+$")


def is_upper(c) -> Column:
    """Python ``isupper``: has a cased letter and no lower-case letter."""
    c = as_col(c)
    return c.rlike("\\p{Lu}") & ~c.rlike("\\p{Ll}")


def is_lower(c) -> Column:
    c = as_col(c)
    return c.rlike("\\p{Ll}") & ~c.rlike("\\p{Lu}")


def is_space(c) -> Column:
    return as_col(c).rlike("^\\s+$")


# F17 --------------------------------------------------------------------
def is_palindrome(c, normalize: bool = False) -> Column:
    """``s == s[::-1]``; with ``normalize`` case and non-alphanumerics are
    ignored."""
    c = as_col(c)
    if normalize:
        c = F.lower(F.regexp_replace(c, "[^\\p{L}\\p{Nd}]", ""))
    return c == F.reverse(c)


# F18 --------------------------------------------------------------------
def digits_only(c) -> Column:
    """Concatenation of all digit characters (``isnumeric`` loop)."""
    return F.regexp_replace(as_col(c), "[^\\p{Nd}]", "")


def extract_numbers(c) -> Column:
    """Every maximal run of digits, as strings."""
    return F.regexp_extract_all(as_col(c), F.lit("(\\d+)"), 1)


# F19 --------------------------------------------------------------------
# Fixed value: a deliberately simple address rule -- one '@' with a
# non-empty local part and a dotted domain, no whitespace or commas.
EMAIL_PATTERN = "^[^@\\s,]+@[^@\\s,]+\\.[^@\\s,]+$"


def is_valid_email(c) -> Column:
    return F.coalesce(as_col(c).rlike(EMAIL_PATTERN), F.lit(False))


# F20 --------------------------------------------------------------------
def to_text(c, default: str = "unknown") -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(default))


# F21 --------------------------------------------------------------------
def alternating_case(c, first_upper: bool = False) -> Column:
    """Characters at even 0-based positions lower (upper when
    ``first_upper``), odd positions the other case."""
    chars = F.split(as_col(c), "")
    even, odd = (F.upper, F.lower) if first_upper else (F.lower, F.upper)
    return F.array_join(F.transform(
        chars, lambda ch, i: F.when(i % 2 == 0, even(ch)).otherwise(odd(ch))), "")


def common_chars(a, b) -> Column:
    """Sorted distinct characters present in both strings."""
    return F.array_sort(F.array_intersect(F.split(as_col(a), ""), F.split(as_col(b), "")))


def char_frequency(c) -> Column:
    """Map character -> count for one string: each different character is
    counted by what its removal takes away. (For whole columns
    ``aggregates.char_frequency``.)"""
    c = as_col(c)
    chars = F.array_distinct(F.filter(F.split(c, ""), lambda ch: ch != ""))
    return F.map_from_entries(F.transform(chars, lambda ch: F.struct(
        ch.alias("key"), (F.length(c) - F.length(F.replace(c, ch, F.lit("")))).alias("value"))))
