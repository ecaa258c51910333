"""Text profile of whole documents (F12-F21 re-aimed at text columns).

Every measure runs over the full text of each row -- no prefixes. Word
splitting follows Python's ``str.split()`` on ASCII whitespace.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import privacy as X
from lakeloom.functions import strings as S
from lakeloom.operators.layout import ensure_parallelism
from lakeloom.plans._common import register, table

# Java's \s class written out for the SQL engine (RE2 lacks \x0B in \s).
_WS = "[\\t\\n\\x0B\\f\\r ]"
_NWS = "[^\\t\\n\\x0B\\f\\r ]+"


def text_profile(df, text_col: str = "text", key: str = "doc_id"):
    """Per-text measures from a few passes over each full text: one
    tokenisation, one pass per Unicode class; the remaining counts are
    arithmetic on those (the classes letter, digit and whitespace are
    disjoint, so specials = chars - letters - digits - whitespace)."""
    base = ensure_parallelism(df.select(key, F.col(text_col).alias("_t")))
    t = F.col("_t")
    staged = base.select(
        key, t, S.split_words(t).alias("_w"), F.length(t).alias("_n"),
        S.count_letters(t).alias("n_letters"), S.count_digits(t).alias("n_digits"),
        S.count_upper(t).alias("n_upper"), S.count_lower(t).alias("n_lower"),
        S.count_vowels(t).alias("n_vowels"), S.count_consonants(t).alias("n_consonants"))
    w = F.col("_w")
    word_chars = F.aggregate(w, F.lit(0), lambda acc, x: acc + F.length(x))
    at_tokens = F.filter(w, lambda x: x.contains("@"))
    staged = staged.withColumns({"_spaces": F.col("_n") - word_chars, "_at": at_tokens})
    return staged.select(
        key,
        F.size(w).alias("n_words"),
        F.array_max(F.transform(w, F.length)).alias("max_word_len"),
        "n_letters", "n_digits", "n_upper", "n_lower",
        F.col("_spaces").alias("n_spaces"),
        (F.col("_n") - F.col("n_letters") - F.col("n_digits") - F.col("_spaces")).alias("n_specials"),
        "n_vowels", "n_consonants",
        F.size(F.filter(w, lambda x: F.startswith(F.lower(x), F.lit("th")))).alias("n_th_words"),
        (F.col("_n") - F.col("n_vowels")).alias("len_without_vowels"),
        (F.col("n_letters") + F.col("n_digits") + F.col("_spaces")).alias("len_without_punct"),
        S.is_palindrome(t, normalize=True).alias("is_palindrome"),
        F.col("n_digits").alias("n_digit_chars"), F.size(S.extract_numbers(t)).alias("n_numbers"),
        F.size("_at").alias("n_at_tokens"),
        F.size(F.filter("_at", lambda x: x.rlike(S.EMAIL_PATTERN))).alias("n_valid_emails"),
        X.hash_col(F.array_join(F.reverse(w), " ")).alias("reversed_words_sha256"),
    )


_WORDS = f"regexp_extract_all(text, '{_NWS}')"


@register("f12_f21_document_text_profile", f"""
SELECT doc_id, CAST(len({_WORDS}) AS INTEGER) AS n_words,
  CAST(list_max(list_transform({_WORDS}, lambda w: length(w))) AS INTEGER) AS max_word_len,
  CAST(len(regexp_extract_all(text, '\\p{{L}}')) AS INTEGER) AS n_letters,
  CAST(len(regexp_extract_all(text, '\\p{{Nd}}')) AS INTEGER) AS n_digits,
  CAST(len(regexp_extract_all(text, '\\p{{Lu}}')) AS INTEGER) AS n_upper,
  CAST(len(regexp_extract_all(text, '\\p{{Ll}}')) AS INTEGER) AS n_lower,
  CAST(len(regexp_extract_all(text, '{_WS}')) AS INTEGER) AS n_spaces,
  CAST(len(regexp_extract_all(text, '[^\\p{{L}}\\p{{Nd}}\\t\\n\\x0B\\f\\r ]')) AS INTEGER) AS n_specials,
  CAST(len(regexp_extract_all(text, '[aeiouAEIOU]')) AS INTEGER) AS n_vowels,
  CAST(len(regexp_extract_all(text, '[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]')) AS INTEGER) AS n_consonants,
  CAST(len(list_filter({_WORDS}, lambda w: starts_with(lower(w), 'th'))) AS INTEGER) AS n_th_words,
  CAST(length(regexp_replace(text, '[aeiouAEIOU]', '', 'g')) AS INTEGER) AS len_without_vowels,
  CAST(length(regexp_replace(text, '[^\\p{{L}}\\p{{Nd}}\\t\\n\\x0B\\f\\r ]', '', 'g')) AS INTEGER) AS len_without_punct,
  lower(regexp_replace(text, '[^\\p{{L}}\\p{{Nd}}]', '', 'g')) = reverse(lower(regexp_replace(text, '[^\\p{{L}}\\p{{Nd}}]', '', 'g'))) AS is_palindrome,
  CAST(length(regexp_replace(text, '[^\\p{{Nd}}]', '', 'g')) AS INTEGER) AS n_digit_chars,
  CAST(len(regexp_extract_all(text, '\\d+')) AS INTEGER) AS n_numbers,
  CAST(len(list_filter({_WORDS}, lambda w: contains(w, '@'))) AS INTEGER) AS n_at_tokens,
  CAST(len(list_filter({_WORDS}, lambda w: regexp_full_match(w, '[^@\\s,]+@[^@\\s,]+\\.[^@\\s,]+'))) AS INTEGER) AS n_valid_emails,
  sha256(array_to_string(list_reverse({_WORDS}), ' ')) AS reversed_words_sha256
FROM documents""")
def f12_f21_document_text_profile(spark, sf):
    return text_profile(table(spark, sf, "documents"))


@register("f12_f21_conversation_text_profile", f"""
SELECT conv_id, turn, CAST(len({_WORDS}) AS INTEGER) AS n_words,
  array_to_string(list_reverse({_WORDS}), ' ') AS reversed_words,
  array_to_string(list_transform(string_split(text, ''), lambda ch, i: CASE WHEN (i - 1) % 2 = 0 THEN lower(ch) ELSE replace(upper(ch), 'ẞ', 'SS') END), '') AS alternating,
  CAST(length(text) AS INTEGER) AS n_chars
FROM conversations""")
def f12_f21_conversation_text_profile(spark, sf):
    c = ensure_parallelism(table(spark, sf, "conversations"))
    return c.select("conv_id", "turn", S.word_count("text").alias("n_words"),
                    S.reverse_words("text").alias("reversed_words"), S.alternating_case("text").alias("alternating"),
                    S.length("text").alias("n_chars"))
