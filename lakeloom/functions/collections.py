"""Arrays, structs and maps.

Python list/dict exercises are re-aimed at array and map columns using
Spark's higher-order functions, so they run per row inside the JVM.
Python index conventions (0-based, negative from the end) are offered
next to Spark's 1-based ones where they differ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions._util import as_col, lit_or_col


# C1-C4, C23 -------------------------------------------------------------
def field(c, path: str) -> Column:
    """Dotted path into structs/maps: ``field('address', 'city')``."""
    out = as_col(c)
    for part in path.split("."):
        out = out.getField(part) if not part.isdigit() else out.getItem(int(part))
    return out


def item(c, index: int) -> Column:
    """0-based strict index (raises out of bounds under ANSI)."""
    return as_col(c)[index]


def safe_item(c, index: int) -> Column:
    """0-based index; NULL when out of bounds. Negative counts from the end."""
    c = as_col(c)
    if index >= 0:
        return F.get(c, F.lit(index))
    return F.when(F.size(c) >= -index, F.element_at(c, F.lit(index)))


def map_get(m, key) -> Column:
    """Case-sensitive key lookup, NULL when the key is absent."""
    return F.try_element_at(as_col(m), lit_or_col(key))


# C5 ---------------------------------------------------------------------
def keys(m) -> Column:
    return F.map_keys(as_col(m))


def values(m) -> Column:
    return F.map_values(as_col(m))


# C10, C11, C12 ----------------------------------------------------------
def zip_arrays(*cols) -> Column:
    """Element-wise zip; the shorter arrays are padded with NULL."""
    return F.arrays_zip(*[as_col(c) for c in cols])


def flatten(c) -> Column:
    return F.flatten(as_col(c))


def contains(c, value) -> Column:
    return F.array_contains(as_col(c), value)


# C13 --------------------------------------------------------------------
def replicate(n: int) -> Column:
    """Array ``[0, n)`` to ``explode`` into n copies of a row."""
    return F.sequence(F.lit(0), F.lit(n - 1))


# C14 --------------------------------------------------------------------
def count_value(c, value) -> Column:
    v = lit_or_col(value)
    return F.size(F.filter(as_col(c), lambda x: x == v))


def index_of(c, value) -> Column:
    """Python ``list.index`` position (0-based), -1 when absent."""
    return (F.array_position(as_col(c), lit_or_col(value)) - 1).cast("int")


# C15 --------------------------------------------------------------------
def distinct_keep_order(c) -> Column:
    """Distinct elements in first-seen order."""
    return F.array_distinct(as_col(c))


def sort(c, descending: bool = False) -> Column:
    return F.sort_array(as_col(c), asc=not descending)


def reverse(c) -> Column:
    return F.reverse(as_col(c))


def rotate_left(c, n) -> Column:
    """``a[n:] + a[:n]`` for any n (taken modulo the length)."""
    c = as_col(c)
    size = F.size(c)
    k = F.when(size > 0, F.pmod(lit_or_col(n), size)).otherwise(F.lit(0))
    return F.when(size == 0, c).otherwise(
        F.concat(F.slice(c, k + 1, size), F.slice(c, F.lit(1), k)))


# C16 / C17 --------------------------------------------------------------
def map_array(c, fn) -> Column:
    return F.transform(as_col(c), fn)


def filter_array(c, pred) -> Column:
    return F.filter(as_col(c), pred)


def reduce_array(c, zero, merge) -> Column:
    return F.aggregate(as_col(c), zero, merge)


def array_max(c) -> Column:
    return F.array_max(as_col(c))


def array_min(c) -> Column:
    return F.array_min(as_col(c))


# C18 --------------------------------------------------------------------
def intersect(a, b) -> Column:
    return F.array_intersect(as_col(a), as_col(b))


def union(a, b) -> Column:
    return F.array_union(as_col(a), as_col(b))


def except_(a, b) -> Column:
    return F.array_except(as_col(a), as_col(b))


def symmetric_difference(a, b) -> Column:
    a, b = as_col(a), as_col(b)
    return F.concat(F.array_except(a, b), F.array_except(b, a))


# C19-C22 ----------------------------------------------------------------
def map_merge_sum(a, b) -> Column:
    """Merge two maps adding values of shared keys (NULL counts as 0)."""
    return F.map_zip_with(as_col(a), as_col(b),
                          lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def map_update(a, b) -> Column:
    """``dict.update`` / ``a | b``: keys of ``b`` win."""
    return F.map_zip_with(as_col(a), as_col(b), lambda k, x, y: F.coalesce(y, x))


def map_filter_values(m, pred) -> Column:
    return F.map_filter(as_col(m), lambda k, v: pred(v))


def map_drop_key(m, key) -> Column:
    k0 = lit_or_col(key)
    return F.map_filter(as_col(m), lambda k, v: k != k0)


def map_has_key(m, key) -> Column:
    return F.map_contains_key(as_col(m), key)


def map_invert(m) -> Column:
    """Swap keys and values. Of entries with one value the last key is kept
    (whatever ``spark.sql.mapKeyDedupPolicy`` says); NULL values, which cannot
    be keys, are left out."""
    def by_value(entries):
        last = F.filter(entries, lambda e, i: e["value"].isNotNull() & ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["value"].eqNullSafe(e["value"])))
        return F.transform(last, lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value")))

    return F.map_from_entries(F.transform(F.array(F.map_entries(as_col(m))), by_value)[0])


def map_sorted_by_value(m, descending: bool = False) -> Column:
    """Entries sorted by value (ties by key) as array<struct<key,value>>."""
    entries = F.map_entries(as_col(m))
    flipped = F.transform(entries, lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k")))
    s = F.sort_array(flipped, asc=not descending)
    return F.transform(s, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))


def map_nulls_to_zero(m) -> Column:
    return F.transform_values(as_col(m), lambda k, v: F.coalesce(v, F.lit(0)))


def map_sum_lists(m) -> Column:
    """map<k, array<num>> -> map<k, sum>."""
    return F.transform_values(as_col(m), lambda k, v: F.aggregate(
        v, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x, F.lit(0))))


# C24 --------------------------------------------------------------------
def append(c, value) -> Column:
    return F.array_append(as_col(c), lit_or_col(value))


def extend(a, b) -> Column:
    return F.concat(as_col(a), as_col(b))


def insert_at(c, index: int, value) -> Column:
    """Python ``list.insert(index, value)`` (0-based; negative inserts before
    that many trailing elements; out-of-range clamps to the ends)."""
    c = as_col(c)
    size = F.size(c)
    i = F.lit(index)
    pos = F.when(i >= 0, F.least(i, size)).otherwise(F.greatest(size + i, F.lit(0)))
    v = F.array(lit_or_col(value))
    return F.concat(F.slice(c, F.lit(1), pos), v,
                    F.slice(c, pos + 1, F.greatest(size - pos, F.lit(0))))


def remove_first(c, value) -> Column:
    """Python ``list.remove``: drops only the first match."""
    c = as_col(c)
    p = F.array_position(c, lit_or_col(value)).cast("int")
    size = F.size(c)
    return F.when(p == 0, c).otherwise(F.concat(
        F.slice(c, F.lit(1), p - 1), F.slice(c, p + 1, F.greatest(size - p, F.lit(0)))))


def remove_all(c, value) -> Column:
    return F.array_remove(as_col(c), value)


def pop(c, index: int = -1) -> Column:
    """Array without the element at Python index ``index``."""
    c = as_col(c)
    size = F.size(c)
    i = F.lit(index)
    p = F.when(i >= 0, i).otherwise(size + i)  # 0-based
    return F.when((p < 0) | (p >= size), c).otherwise(F.concat(
        F.slice(c, F.lit(1), p), F.slice(c, p + 2, F.greatest(size - p - 1, F.lit(0)))))
