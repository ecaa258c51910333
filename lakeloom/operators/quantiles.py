"""Exact percentiles by sketch-bracketed selection.

1. One scan builds a mergeable quantile sketch per group: for each wanted
   probability two values that enclose its exact rank (the sketch's rank error
   is bounded, so the enclosure is certain), and the number of rows.
2. A second scan counts rows: rows outside all brackets fall into a few counters
   per group, rows inside are counted by value, so ties of any number are one
   row a task. A bracket holds about a thousandth of a large group. Inside a
   bracket values are dealt to slots of equal width.
3. Running totals of counters and slots locate the slot of each wanted rank;
   only the values of those slots are put in order.

Nothing but the counted rows is shuffled or written, and no group is held in a
task. The result is the linearly interpolated percentile (position
``(n - 1) * p``), the same as pandas ``quantile``, Spark ``percentile`` and SQL
``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators._store import BROADCAST_BYTES, row_bytes, stored

#: the sketch's rank error is at most rows / ACCURACY
ACCURACY = 10_000
#: groups of at most so many rows are bracketed as a whole
SMALL_GROUP = 4_000
#: slots of equal width in a bracket
SLOTS = 1_024


def _label(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"p{s}"


def _pack(group_cols: Sequence[str]) -> Column:
    """The group key as one struct: every internal join is an equi join on it,
    NULL fields compare equal (a NULL group is one group), and no group at all
    is a single constant group."""
    return F.struct(*[F.col(c) for c in group_cols]) if group_cols else F.struct(F.lit(0).alias("_all"))


def percentile_table(keyed: DataFrame, probs: Sequence[float], names: Sequence[str],
                     extra: Sequence[Column] = ()) -> DataFrame:
    """One row per group of ``keyed`` (``_gk``, ``_v`` double): ``_gk``, the
    aggregates ``extra`` and a column per probability (NULL for groups of only
    NULLs). ``extra`` is computed in the scan that builds the sketches. The
    result carries a broadcast hint if the groups were counted to be few."""
    probs = [float(p) for p in probs]
    wanted = sorted(set(probs))
    margin = 4 / ACCURACY + 1 / SMALL_GROUP
    marks = [max(0.0, p - margin) for p in wanted] + [min(1.0, p + margin) for p in wanted]
    k, v = len(wanted), F.col("_v")
    sketch = keyed.groupBy("_gk").agg(
        *extra, F.count(v).alias("_n"), F.min(v).alias("_min"), F.max(v).alias("_max"),
        F.percentile_approx(v, marks, ACCURACY).alias("_q"))
    small = F.col("_n") <= SMALL_GROUP
    sketch = sketch.withColumn("_lo", F.when(small, F.array_repeat("_min", k)).otherwise(F.slice("_q", 1, k)))
    sketch = sketch.withColumn("_hi", F.when(small, F.array_repeat("_max", k)).otherwise(F.slice("_q", k + 1, k)))
    groups = stored(sketch.drop("_q", "_min", "_max"), "sketches")
    few = groups.count() * (row_bytes(groups) + 32 * k) <= BROADCAST_BYTES  # counted from the file footers
    side = F.broadcast if few else (lambda table: table)

    # cell: how many brackets begin at or below the value; both ends rise with
    # the probability, so a value is inside a bracket if it is inside the last of those
    rows = keyed.where(v.isNotNull()).join(side(groups.select("_gk", "_lo", "_hi")), "_gk")
    cell = sum(((v >= F.col("_lo")[i]).cast("int") for i in range(1, k)), (v >= F.col("_lo")[0]).cast("int"))
    rows = rows.select("_gk", "_v", "_lo", "_hi", cell.alias("_cell"))
    low, high = F.get("_lo", F.col("_cell") - 1), F.get("_hi", F.col("_cell") - 1)
    rows = rows.select("_gk", "_v", "_cell", low.alias("_a"), high.alias("_b"))
    width, inside = F.col("_b") - F.col("_a"), F.coalesce(v <= F.col("_b"), F.lit(False))
    slot = F.when((width > 0) & (width < float("inf")), F.least(F.floor((v - F.col("_a")) / width * SLOTS), F.lit(SLOTS - 1))).otherwise(0)
    rows = rows.select("_gk", "_cell", F.when(inside, slot).otherwise(SLOTS).cast("int").alias("_slot"), F.when(inside, v).alias("_v"))
    counted = stored(rows.groupBy("_gk", "_cell", "_slot", "_v").agg(F.count(F.lit(1)).alias("_w")), "bracketed")

    # at most SLOTS + 1 totals a bracket and group; outside rows come after the inside rows of their cell
    order = Window.partitionBy("_gk").orderBy("_cell", "_slot")
    totals = counted.groupBy("_gk", "_cell", "_slot").agg(F.sum("_w").alias("_c"))
    totals = totals.withColumn("_before", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c"))
    ranks = groups.select("_gk", F.array(*[f((F.col("_n") - 1) * p).cast("long") for p in wanted for f in (F.floor, F.ceil)]).alias("_ranks"))
    here = F.filter("_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")))
    located = totals.join(side(ranks), "_gk").select("_gk", "_cell", "_slot", "_before", here.alias("_here")).where(F.size("_here") > 0)

    w = Window.partitionBy("_gk", "_cell", "_slot").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = counted.join(located, ["_gk", "_cell", "_slot"]).withColumn("_to", F.col("_before") + F.sum("_w").over(w))
    held = F.filter(F.array_distinct("_here"), lambda r: (r >= F.col("_to") - F.col("_w")) & (r < F.col("_to")))
    # a wanted rank among rows outside all brackets cannot be, by the sketch's bound
    value = F.when(F.col("_slot") < SLOTS, F.col("_v")).otherwise(F.raise_error(F.lit("a quantile sketch missed its bound")).cast("double"))
    found = walked.select("_gk", F.explode(held).alias("_r"), value.alias("_x")).groupBy("_gk").agg(
        F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at"))  # two ranks a probability
    out = groups.join(found, "_gk", "left")
    columns = []
    for p, name in zip(probs, names):
        h = (F.col("_n") - 1) * p
        lo, hi = F.col("_at")[F.floor(h).cast("long")], F.col("_at")[F.ceil(h).cast("long")]
        columns.append(F.when(lo == hi, lo).otherwise(lo + (h - F.floor(h)) * (hi - lo)).alias(name))  # equal infinities
    return side(out.drop("_lo", "_hi").select("*", *columns).drop("_at"))


def exact_percentiles(df: DataFrame, value_col: str, probs: Sequence[float],
                      group_cols: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """One row per group with one column per probability (NULL values are
    ignored; a group of only NULLs is absent)."""
    group_cols = list(group_cols)
    names = list(names) if names else [_label(p) for p in probs]
    keyed = df.select(_pack(group_cols).alias("_gk"), F.col(value_col).cast("double").alias("_v"))
    out = percentile_table(keyed, probs, names).where("_n > 0")
    return out.select(*[F.col(f"_gk.{c}").alias(c) for c in group_cols], *names)


def exact_median(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                 name: str = "median") -> DataFrame:
    return exact_percentiles(df, value_col, [0.5], group_cols, [name])


def approx_percentiles(df: DataFrame, value_col: str, probs: Sequence[float],
                       group_cols: Sequence[str] = (), names: Sequence[str] | None = None,
                       accuracy: int = 10000) -> DataFrame:
    """Approximate percentiles (``percentile_approx``): a bounded-size sketch
    per group, merged map-side, so cost does not depend on how values are
    spread. The rank error is at most ``n / accuracy``."""
    group_cols = list(group_cols)
    names = list(names) if names else [_label(p) for p in probs]
    arr = F.percentile_approx(F.col(value_col).cast("double"), [float(p) for p in probs], accuracy)
    out = df.groupBy(*group_cols).agg(arr.alias("_q"))
    return out.select(*group_cols, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
