"""Masking, hashing and reversible encryption of personal fields.

All of these are Catalyst expressions; NULL input yields the caller's
default text (``unknown``) instead of failing as a Python UDF would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions._util import as_col

UNKNOWN = "unknown"


def mask_keep_last(c, keep: int, prefix: str, default: str = UNKNOWN) -> Column:
    """Fixed ``prefix`` followed by the last ``keep`` characters."""
    c = as_col(c)
    return F.coalesce(F.concat(F.lit(prefix), F.right(c, F.lit(keep))), F.lit(default))


def mask_keep_last_same_length(c, keep: int, mask_char: str = "*",
                               default: str = UNKNOWN) -> Column:
    """Variant whose mask tracks the input length."""
    c = as_col(c)
    n = F.length(c)
    masked = F.concat(F.repeat(F.lit(mask_char), F.greatest(n - keep, F.lit(0))), F.right(c, F.lit(keep)))
    return F.coalesce(masked, F.lit(default))


def mask_keep_middle(c, keep: int = 4, mask_char: str = "X", default: str = UNKNOWN) -> Column:
    """Keep ``keep`` centred characters (start at ``(n - keep) // 2``) and
    mask both ends with ``mask_char``."""
    c = as_col(c)
    n = F.length(c)
    start = F.floor((n - keep) / 2).cast("int")
    start = F.greatest(start, F.lit(0))
    middle = F.substring(c, start + 1, keep)
    masked = F.concat(F.repeat(F.lit(mask_char), start), middle,
                      F.repeat(F.lit(mask_char), F.greatest(n - start - keep, F.lit(0))))
    return F.coalesce(masked, F.lit(default))


def mask_span(c, start: int, stop: int, mask_char: str = "x", default: str = UNKNOWN) -> Column:
    """``s[:start] + mask_char * (stop - start) + s[stop:]`` (0-based)."""
    c = as_col(c)
    masked = F.concat(F.substring(c, 1, start), F.lit(mask_char * (stop - start)),
                      F.substring(c, stop + 1, 2147483647))
    return F.coalesce(masked, F.lit(default))


def hash_col(c, salt: str | None = None, bits: int = 256, default: str = UNKNOWN) -> Column:
    """Irreversible SHA-2 hex digest (lower-case), optionally salted."""
    c = as_col(c).cast("string")
    if salt:
        c = F.concat(F.lit(salt), c)
    return F.coalesce(F.sha2(c, bits), F.lit(default))


def encrypt_col(c, key: str | Column) -> Column:
    """AES-GCM encryption, base64 text. The key (16/24/32 bytes) comes from
    the caller, e.g. a secret scope or environment; it is never stored."""
    k = key if isinstance(key, Column) else F.lit(key)
    return F.base64(F.aes_encrypt(as_col(c).cast("string"), k, F.lit("GCM")))


def decrypt_col(c, key: str | Column) -> Column:
    k = key if isinstance(key, Column) else F.lit(key)
    return F.aes_decrypt(F.unbase64(as_col(c)), k, F.lit("GCM")).cast("string")
