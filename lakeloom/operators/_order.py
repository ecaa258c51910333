"""Ordering helpers shared by the window and quantile operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators._store import stored


def sort_key(spec) -> Column:
    """``"x"`` -> asc nulls first (Spark default); ``("x", "desc")`` ->
    desc nulls last; a Column is used as given."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        return F.col(spec).asc()
    name, direction = spec
    if direction.lower().startswith("desc"):
        return F.col(name).desc()
    return F.col(name).asc()


def as_specs(order_by) -> list:
    """Normalise one spec or a list of specs to a list."""
    if isinstance(order_by, (str, Column)):
        return [order_by]
    if (isinstance(order_by, tuple) and len(order_by) == 2 and isinstance(order_by[1], str)
            and order_by[1].lower() in ("asc", "desc")):
        return [order_by]
    return list(order_by)


def sort_keys(order_by) -> list[Column]:
    return [sort_key(s) for s in as_specs(order_by)]


def key_names(order_by) -> list[str]:
    """Column names of an order spec (Columns are not accepted here)."""
    names = []
    for s in as_specs(order_by):
        if isinstance(s, str):
            names.append(s)
        elif isinstance(s, tuple):
            names.append(s[0])
        else:
            raise TypeError("order keys must be names or (name, 'asc'|'desc')")
    return names


def default_partitions(df: DataFrame) -> int:
    """Number of ordered segments: ``lakeloom.segments`` when the session
    sets it (size it so one segment is a few hundred MB), else the shuffle
    partition count."""
    conf = df.sparkSession.conf
    return int(conf.get("lakeloom.segments", None) or conf.get("spark.sql.shuffle.partitions"))


def _key_part(df: DataFrame, spec) -> tuple[Column, bool, bool]:
    """(value, falling, nulls first) of one order spec."""
    if isinstance(spec, str):
        return F.col(spec), False, True
    if isinstance(spec, tuple):
        falling = spec[1].lower().startswith("desc")
        return F.col(spec[0]), falling, not falling
    text = re.fullmatch(r"Column<'(.*)'>", str(spec), re.S).group(1)
    ordered = re.fullmatch(r"(.*) (ASC|DESC) NULLS (FIRST|LAST)", text, re.S)
    if not ordered:
        return spec, False, True
    name = ordered.group(1)
    return F.col(f"`{name}`") if name in df.columns else F.expr(name), ordered.group(2) == "DESC", ordered.group(3) == "FIRST"


def _before(a: Column, b: Column, falling: bool, nulls_first: bool) -> Column:
    """Whether ``a`` comes strictly before ``b``."""
    return (F.when(a.isNull() & b.isNull(), False).when(a.isNull(), nulls_first).when(b.isNull(), not nulls_first)
            .otherwise(a > b if falling else a < b))


#: different keys that are sampled for each segment
KEYS_PER_SEGMENT = 128


def range_bounds(df: DataFrame, parts: Sequence[tuple[Column, bool, bool]], n: int) -> DataFrame:
    """One row with ``_bounds``: the first key of each segment but the first,
    an array of at most ``n - 1`` structs (``k0``, ``k1``, ...) in key order.

    Only the key columns are read. Keys are sampled by a hash of the key, so a
    key is in the sample with all its rows or not at all, whatever the layout of
    the table: the same table always gives the same bounds. Sampled keys count
    by their rows. The sample's size follows from the number of different keys
    (all of them if they are few), not from the table's."""
    names = [f"k{i}" for i in range(len(parts))]
    keys = df.select(*[c.alias(k) for (c, _, _), k in zip(parts, names)])
    packed = F.struct(*names)
    different = keys.agg(F.approx_count_distinct(packed)).first()[0]
    if different > 2 * KEYS_PER_SEGMENT * n:
        share = KEYS_PER_SEGMENT * n / different
        keys = keys.where(F.pmod(F.xxhash64(*names), F.lit(1 << 30)) < int(share * (1 << 30)))
    order = [(F.col(k).desc_nulls_first() if first else F.col(k).desc_nulls_last()) if falling
             else (F.col(k).asc_nulls_first() if first else F.col(k).asc_nulls_last())
             for k, (_, falling, first) in zip(names, parts)]
    sample = keys.groupBy(*names).agg(F.count(F.lit(1)).alias("w"))  # a bounded number of rows from here on
    up_to = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.floor((F.sum("w").over(up_to) - F.col("w")) * n / F.sum("w").over(every)).cast("int")
    firsts = sample.select(packed.alias("k"), place.alias("s"), F.row_number().over(Window.orderBy(*order)).alias("r"))
    firsts = firsts.where("s > 0").groupBy("s").agg(F.min(F.struct("r", "k")).alias("f")).select("f.r", "f.k")
    return firsts.agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "k"))), lambda x: x["k"]).alias("_bounds"))


def segment_of(bounds: Column, parts: Sequence[tuple[Column, bool, bool]], n: int) -> Column:
    """Number of bounds at or before the row's key, by binary search."""
    def at_or_before(b: Column) -> Column:
        out = F.lit(True)
        for i, (c, falling, first) in reversed(list(enumerate(parts))):
            out = _before(b[f"k{i}"], c, falling, first) | (b[f"k{i}"].eqNullSafe(c) & out)
        return out

    def step(state: Column, _: Column) -> Column:
        middle = ((state["lo"] + state["hi"]) / 2).cast("int")
        right = at_or_before(F.get(bounds, middle))
        return F.when(state["lo"] >= state["hi"], state).when(
            right, F.struct((middle + 1).alias("lo"), state["hi"].alias("hi"))).otherwise(F.struct(state["lo"].alias("lo"), middle.alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, n.bit_length() + 1))), start, step, lambda state: state["lo"])


def range_segments(df: DataFrame, specs: Sequence, n: int | None = None, seg_col: str = "_seg") -> DataFrame:
    """``df`` with the number of each row's ordered segment, 0 to ``n - 1``.

    Segments follow the sort order (segment i holds keys before those of
    segment i+1) and rows with equal keys share a segment, so a whole-table
    order or a hot group is split over many tasks of similar size.

    The bounds are data: stored once, from a hash sample of the keys (see
    ``range_bounds``). The tag is a plain expression over the row's own keys, so
    ``df`` itself is neither shuffled nor written here, every reading of the
    result and every repeated task sees the same segments, and callers may
    read it as often as they need. ``df`` has to give the same rows each time."""
    n = n or default_partitions(df)
    parts = [_key_part(df, s) for s in specs]
    bounds = stored(range_bounds(df, parts, n), "bounds")
    held = "_bounds"
    return df.withColumn(held, bounds.scalar()).withColumn(seg_col, segment_of(F.col(held), parts, n)).drop(held)
