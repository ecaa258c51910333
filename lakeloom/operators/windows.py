"""Window operators (W1-W20) and order-dependent row operators.

Design rules for scale:

* No operator looks at the data to choose its path. Jobs that run while a
  query is built: the ``segmented_*`` and whole-table forms read their key
  columns for the segments' bounds, group extremes are stored before they are
  joined back.
* Per-group windows partition by the group key. For groups too large for
  one task the caller asks for the ``segmented_*`` form of the operator, which
  gives the same rows from ordered segments (bounds are data, rows are tagged).
* Top-n and dedup always run in two stages: a salted first pass keeps only
  rows that can still reach the final cut, the exact final pass ranks those
  survivors. Ties are reduced to one row a key before they are ranked.
* Ranks, positions and counts are ``bigint``.
* Windows with no partition key (global rank, global running total, row
  positions) never run in one task: rows are dealt to
  ordered segments, ranked/summed locally, and shifted by the counts/sums
  of earlier segments (a small per-segment table).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators._store import stored_side
from lakeloom.operators._order import as_specs, key_names, range_segments, sort_keys

_RANKERS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _gkey(keys: list[str]) -> Column:
    """The group key packed into one struct column. Joins on it treat NULL
    fields as equal, so a NULL group stays one group (as in a window)."""
    return F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)


# W1-W3, W9, W11-W14, W16 ------------------------------------------------
def rank_within(df: DataFrame, partition_by, order_by, method: str = "row_number",
                out: str = "rank") -> DataFrame:
    """Per-group ranking column (every row kept): one window, one task per
    group. ``segmented_rank_within`` gives the same ranks for groups of any
    size. Order keys may be names, (name, direction) or Columns in both."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*sort_keys(order_by))
    return df.withColumn(out, _RANKERS[method]().over(w).cast("long"))


def segmented_ranks_within(df: DataFrame, partition_by, order_by, outputs: dict[str, str],
                           segments: int | None = None) -> DataFrame:
    """Several rankings (column -> method) of groups of any size, from one
    segmentation: local ranks inside (group, segment) plus, for the groups
    that continue across a segment edge (at most two a segment), the rows or
    different keys of their earlier segments."""
    keys, okeys = _cols(partition_by), sort_keys(order_by)
    local = range_segments(df, [*keys, *as_specs(order_by)], segments).withColumn("_gk", _gkey(keys))
    w = Window.partitionBy("_gk", "_seg").orderBy(*okeys)
    local = local.withColumn("_dense", F.dense_rank().over(w).cast("long"))
    edge = local.join(F.broadcast(_edge_groups(local)), ["_gk", "_seg"], "left_semi")
    # the largest dense rank of a part is its number of different keys
    stats = edge.groupBy("_gk", "_seg").agg(F.count(F.lit(1)).alias("_rows"), F.max("_dense").alias("_keys"))
    before = Window.partitionBy("_gk").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select("_gk", "_seg", F.sum("_rows").over(before).alias("_o_rows"), F.sum("_keys").over(before).alias("_o_keys"))
    out = local
    for name, method in outputs.items():
        out = out.withColumn(f"_l_{name}", _RANKERS[method]().over(w).cast("long"))
    out = out.join(F.broadcast(offs), ["_gk", "_seg"], "left")
    for name, method in outputs.items():
        off = F.coalesce(F.col("_o_keys" if method == "dense_rank" else "_o_rows"), F.lit(0))
        out = out.withColumn(name, F.col(f"_l_{name}") + off).drop(f"_l_{name}")
    return out.drop("_dense", "_o_rows", "_o_keys", "_seg", "_gk")


def segmented_rank_within(df: DataFrame, partition_by, order_by, method: str = "row_number",
                          out: str = "rank", segments: int | None = None) -> DataFrame:
    """``rank_within`` for groups of any size."""
    return segmented_ranks_within(df, partition_by, order_by, {out: method}, segments)


def _salts(df: DataFrame) -> int:
    """How many parts a hot group is cut into: as many as a shuffle has."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def top_n_per_group(df: DataFrame, partition_by, order_by, n: int = 1,
                    method: str = "row_number", out: str | None = None,
                    exact_rank: int | None = None) -> DataFrame:
    """Rows whose per-group rank is ``<= n`` (``== exact_rank`` when given).

    ``method`` picks ties: ``row_number`` (one row per position; pass a total
    order), ``rank`` (ties share a rank, gaps follow), ``dense_rank``.

    Two stages: stage 1 ranks inside ``(group, salt)`` and keeps local rank
    ``<= n`` -- a local rank never exceeds the group rank, so no row that can
    qualify is dropped, and a hot group is spread over many tasks; stage 2
    ranks the few survivors per group. With ``rank`` and ``dense_rank`` both
    stages rank the *different order keys* of a group with their row counts
    (a partial aggregate), so ties of any size never meet in one task; the
    rows are then picked by an equi join on (group, order keys).
    """
    parts, limit, col = _cols(partition_by), n if exact_rank is None else exact_rank, out or "_rank"
    wanted = F.col(col) == exact_rank if exact_rank is not None else F.col(col) <= n

    def salted(frame, keys):
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]), F.lit(_salts(df)))
        w = Window.partitionBy(*parts, "_salt").orderBy(*keys)
        return (frame.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w))
                .where(F.col("_r1") <= limit).drop("_r1", "_salt"))

    if method == "row_number":
        keys = sort_keys(order_by)
        ranked = salted(df, keys).withColumn(col, F.row_number().over(Window.partitionBy(*parts).orderBy(*keys)).cast("long"))
        ranked = ranked.where(wanted)
        return ranked if out else ranked.drop(col)
    keyed, names, specs = _named_keys(df, order_by)
    keys = sort_keys(specs)
    distinct = keyed.groupBy(*parts, *[c for c in names if c not in parts]).agg(F.count(F.lit(1)).alias("_c"))
    few = salted(distinct, keys)
    w = Window.partitionBy(*parts).orderBy(*keys)
    rank = (F.row_number().over(w) if method == "dense_rank" else
            F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
    few = few.withColumn(col, rank.cast("long")).where(wanted)
    both = [*parts, *[c for c in names if c not in parts]]
    picked = few.select(_gkey(both).alias("_gk"), col)
    joined = keyed.withColumn("_gk", _gkey(both)).join(picked, "_gk")
    return joined.select(*df.columns, *([col] if out else []))


def _named_keys(df: DataFrame, order_by) -> tuple[DataFrame, list[str], list]:
    """``df`` with a column for each order key, their names, and order specs
    on those names. Column keys must carry no direction (they sort ascending
    with NULL first) -- give ``(name, "desc")`` for the other one."""
    names, specs = [], []
    for k, spec in enumerate(as_specs(order_by)):
        if isinstance(spec, Column):
            df = df.withColumn(f"_key{k}", spec)
            spec = f"_key{k}"
        specs.append(spec)
        names.append(spec if isinstance(spec, str) else spec[0])
    return df, names, specs


def dedup_keep_first(df: DataFrame, keys, order_by) -> DataFrame:
    """One surviving row per key: the first by ``order_by`` (make it a
    total order for a deterministic survivor).

    When every order key has the same direction, the survivor is
    ``min`` (or ``max``) of a struct of (order keys, other columns) per key.
    A struct buffer needs a sort-based aggregate, but it is partial: each
    task sorts its own rows and sends one row a key, so a hot key is reduced
    before the shuffle. Struct comparison matches the window order (NULL
    fields first ascending, last descending). Mixed directions use the
    two-stage ranking; both give the same survivor under a total order.
    """
    specs = as_specs(order_by)
    names = key_names(specs) if all(isinstance(x, (str, tuple)) for x in specs) else None
    dirs = {("desc" if isinstance(x, tuple) and x[1].lower().startswith("desc") else "asc") for x in specs}
    if names is not None and len(dirs) == 1:
        keys = _cols(keys)
        names = [c for c in names if c not in keys]  # constant within a group
        rest = [c for c in df.columns if c not in keys and c not in names]
        pick = F.max if dirs == {"desc"} else F.min
        best = pick(F.struct(*[F.col(c) for c in names + rest])).alias("_best")
        return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in names + rest]) \
            .select(*df.columns)
    return top_n_per_group(df, keys, order_by, 1, "row_number")


def latest_per_entity(df: DataFrame, keys, ts_col: str, tie_break=None,
                      keep_ties: bool = False) -> DataFrame:
    """Latest row per entity (W15). ``keep_ties`` keeps every row sharing the
    latest timestamp (rank semantics) via a group max + join, which is a
    partial aggregate and therefore safe for hot keys."""
    keys = _cols(keys)
    if keep_ties:
        mx = stored_side(df.groupBy(_gkey(keys).alias("_gk")).agg(F.max(ts_col).alias("_mx")), "latest")
        return (df.withColumn("_gk", _gkey(keys)).join(mx, "_gk")
                .where(F.col(ts_col) == F.col("_mx")).drop("_mx", "_gk"))
    order = [(ts_col, "desc")] + [(c, "desc") for c in _cols(tie_break)]
    return dedup_keep_first(df, keys, order)


def rows_at_group_extreme(df: DataFrame, keys, value_col: str, kind: str = "max") -> DataFrame:
    """Rows equal to their group's max (or min) -- ties kept (A21, CSQ
    correlated max). The extremes are stored once and, if few, sent to the rows."""
    keys = _cols(keys)
    agg = F.max if kind == "max" else F.min
    ext = df.groupBy(_gkey(keys).alias("_gk")).agg(agg(value_col).alias("_ext"))
    return (df.withColumn("_gk", _gkey(keys)).join(stored_side(ext, "extremes"), "_gk")
            .where(F.col(value_col) == F.col("_ext")).drop("_ext", "_gk"))


# W5-W8 ------------------------------------------------------------------
def with_lead_lag(df: DataFrame, partition_by, order_by, value_col: str,
                  offset: int = 1, lead_name: str | None = None,
                  lag_name: str | None = None, default=None) -> DataFrame:
    """``lead``/``lag`` of ``value_col`` by ``offset`` within each group: one
    window, one task per group. ``default`` stands where there is no such row;
    a neighbour that is NULL stays NULL. ``segmented_lead_lag`` gives the
    same for groups of any size."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*sort_keys(order_by))
    if lead_name:
        df = df.withColumn(lead_name, F.lead(value_col, offset, default).over(w))
    if lag_name:
        df = df.withColumn(lag_name, F.lag(value_col, offset, default).over(w))
    return df


def diff_to_previous(df: DataFrame, partition_by, order_by, value_col: str,
                     out: str = "diff_prev") -> DataFrame:
    prev = with_lead_lag(df, partition_by, order_by, value_col, 1, lag_name="_prev")
    return prev.withColumn(out, F.col(value_col) - F.col("_prev")).drop("_prev")


def rows_above_previous(df: DataFrame, partition_by, order_by, value_col: str) -> DataFrame:
    """Rows whose value is greater than the previous row's (window result is
    projected first, then filtered: windows are not allowed in WHERE)."""
    prev = with_lead_lag(df, partition_by, order_by, value_col, 1, lag_name="_prev")
    return prev.where(F.col(value_col) > F.col("_prev")).drop("_prev")


def _edge_groups(seg: DataFrame) -> DataFrame:
    """First and last group (``_gk``) of every segment. A group continuing
    across a segment boundary is the last group of one segment and the first
    of the next, so at most two groups per segment need carried values. The
    struct order matches the range order (NULL fields first)."""
    b = seg.groupBy("_seg").agg(F.min("_gk").alias("_first"), F.max("_gk").alias("_last"))
    return b.select("_seg", F.explode(F.array("_first", "_last")).alias("_gk")).distinct()


def segmented_lead_lag(df: DataFrame, partition_by, order_by, value_col: str, offset: int = 1,
                       lead_name: str | None = None, lag_name: str | None = None,
                       default=None, segments: int | None = None) -> DataFrame:
    """Per-group lead/lag that splits large groups over ordered segments.

    1. Range-partition on (group, order) into segments; lead/lag inside each
       (group, segment).
    2. Only the first/last ``offset`` rows of groups at a segment edge can
       need rows from a neighbouring segment. Those edge rows (at most
       ``4 * offset`` per segment, independent of the data size) are taken
       out, lead/lag is recomputed over them in (segment, order) order --
       exact, because an edge group's rows outside the edge window are never
       within ``offset`` of a neighbouring segment -- and the fixed values
       are broadcast back onto the local result.
    """
    keys = _cols(partition_by)
    okeys = sort_keys(order_by)
    seg = range_segments(df, [*keys, *as_specs(order_by)], segments).withColumn("_gk", _gkey(keys))
    wl = Window.partitionBy("_gk", "_seg").orderBy(*okeys)
    local = (seg.withColumn("_rn", F.row_number().over(wl))
             .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy("_gk", "_seg"))))
    if lead_name:
        local = local.withColumn(lead_name, F.lead(value_col, offset, default).over(wl))
    if lag_name:
        local = local.withColumn(lag_name, F.lag(value_col, offset, default).over(wl))
    edges = _edge_groups(seg)
    near_edge = (F.col("_rn") <= offset) | (F.col("_rn") > F.col("_cnt") - offset)
    edge_rows = local.join(F.broadcast(edges), ["_gk", "_seg"], "left_semi").where(near_edge)
    we = Window.partitionBy("_gk").orderBy(F.col("_seg"), *okeys)
    fix_cols = []
    if lead_name:
        edge_rows = edge_rows.withColumn(f"_fix_{lead_name}", F.lead(value_col, offset, default).over(we))
        fix_cols.append(lead_name)
    if lag_name:
        edge_rows = edge_rows.withColumn(f"_fix_{lag_name}", F.lag(value_col, offset, default).over(we))
        fix_cols.append(lag_name)
    # lag reaches back only from a segment's first rows, lead forward only
    # from its last rows; elsewhere the local value is already exact
    applies = {lead_name: F.col("_rn") > F.col("_cnt") - offset, lag_name: F.col("_rn") <= offset}
    fixes = edge_rows.select("_gk", "_seg", "_rn", *[
        F.struct(applies[c].alias("on"), F.col(f"_fix_{c}").alias("v")).alias(f"_fix_{c}") for c in fix_cols])
    out = local.join(F.broadcast(fixes), ["_gk", "_seg", "_rn"], "left")
    for c in fix_cols:
        out = out.withColumn(c, F.when(F.col(f"_fix_{c}.on"), F.col(f"_fix_{c}.v")).otherwise(F.col(c)))
    return out.drop("_seg", "_rn", "_cnt", "_gk", *[f"_fix_{c}" for c in fix_cols])


# W10 --------------------------------------------------------------------
def running_total(df: DataFrame, partition_by, order_by, value_col: str,
                  out: str = "running_total", rows: bool = False) -> DataFrame:
    """Per-group running sum. ``rows=False`` is the SQL default RANGE frame
    (peers with equal order keys are summed together)."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*sort_keys(order_by))
    w = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if rows
         else w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(value_col).over(w))


def segmented_running_total(df: DataFrame, partition_by, order_by, value_col: str,
                            out: str = "running_total", rows: bool = False,
                            segments: int | None = None) -> DataFrame:
    """``running_total`` for groups of any size: running sums inside (group,
    segment) plus the group's sums of earlier segments, which only groups at
    a segment edge have (at most two a segment). Rows with equal keys share a
    segment, so the RANGE frame stays exact."""
    keys, okeys = _cols(partition_by), sort_keys(order_by)
    seg = range_segments(df, [*keys, *as_specs(order_by)], segments).withColumn("_gk", _gkey(keys))
    w = Window.partitionBy("_gk", "_seg").orderBy(*okeys)
    w = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if rows
         else w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = seg.withColumn("_local", F.sum(value_col).over(w))
    edge = seg.join(F.broadcast(_edge_groups(seg)), ["_gk", "_seg"], "left_semi")
    before = Window.partitionBy("_gk").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offs = edge.groupBy("_gk", "_seg").agg(F.sum(value_col).alias("_t")).select("_gk", "_seg", F.sum("_t").over(before).alias("_off"))
    # a NULL sum is a sum of NULLs only: it adds nothing, and stays NULL alone
    total = F.when(F.col("_local").isNull(), F.col("_off")).otherwise(F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)))
    return (local.join(F.broadcast(offs), ["_gk", "_seg"], "left").withColumn(out, total)
            .drop("_local", "_off", "_seg", "_gk"))


def global_running_total(df: DataFrame, order_by, value_col: str,
                         out: str = "running_total", rows: bool = False,
                         segments: int | None = None) -> DataFrame:
    """Running sum over the whole table with no partition key, computed in
    ordered segments: local running sum + the total of all earlier segments.
    Rows with equal order keys share a segment, so the RANGE frame (peers
    summed together) stays exact. With ``rows=True`` give a total order."""
    keys = sort_keys(order_by)
    seg = range_segments(df, as_specs(order_by), segments)
    w = Window.partitionBy("_seg").orderBy(*keys)
    w = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if rows
         else w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = seg.withColumn("_local", F.sum(value_col).over(w))
    totals = seg.groupBy("_seg").agg(F.sum(value_col).alias("_t"))
    offs = totals.withColumn("_off", F.coalesce(F.sum("_t").over(
        Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offs.select("_seg", "_off")), "_seg")
            .withColumn(out, F.col("_local") + F.col("_off"))
            .drop("_local", "_off", "_seg"))


# W4 ---------------------------------------------------------------------
def global_rank(df: DataFrame, order_by, method: str = "rank", out: str = "rank",
                segments: int | None = None) -> DataFrame:
    """rank / dense_rank / row_number over the whole table, no partition key.

    Ranked in ordered segments and shifted by the row count (rank,
    row_number) or distinct-key count (dense_rank) of earlier segments;
    equal keys share a segment, so ties are exact.
    """
    keys = sort_keys(order_by)
    key_cols = key_names(order_by)
    seg = range_segments(df, as_specs(order_by), segments)
    w = Window.partitionBy("_seg").orderBy(*keys)
    local = seg.withColumn("_lr", _RANKERS[method]().over(w))
    if method == "dense_rank":
        # distinct key tuples per segment; a struct of NULL fields is a
        # value (never NULL itself), matching dense_rank's NULL peers
        stats = seg.groupBy("_seg").agg(F.count_distinct(
            F.struct(*[F.col(c) for c in key_cols])).alias("_c"))
    else:
        stats = seg.groupBy("_seg").agg(F.count(F.lit(1)).alias("_c"))
    offs = stats.withColumn("_off", F.coalesce(F.sum("_c").over(
        Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offs.select("_seg", "_off")), "_seg")
            .withColumn(out, F.col("_lr").cast("long") + F.col("_off"))
            .drop("_lr", "_off", "_seg"))


def global_ranks(df: DataFrame, order_by, outputs: dict, tie_break=None,
                 segments: int | None = None) -> DataFrame:
    """Several whole-table rankings from one segmentation. ``outputs`` maps
    column name -> ``rank`` | ``dense_rank`` | ``row_number``; row numbers
    follow ``order_by`` then ``tie_break``. Segments are cut on ``order_by``
    only, so a tie group never straddles two segments and the row-number
    refinement stays inside one segment."""
    keys = sort_keys(order_by)
    key_cols = key_names(order_by)
    seg = range_segments(df, as_specs(order_by), segments)
    w = Window.partitionBy("_seg").orderBy(*keys)
    w_rn = Window.partitionBy("_seg").orderBy(*(keys + (sort_keys(tie_break) if tie_break else [])))
    local = seg
    for name, method in outputs.items():
        local = local.withColumn(f"_l_{name}", _RANKERS[method]().over(w_rn if method == "row_number" else w))
    stats = seg.groupBy("_seg").agg(
        F.count(F.lit(1)).alias("_c"),
        F.count_distinct(F.struct(*[F.col(c) for c in key_cols])).alias("_d"))
    before = Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select("_seg", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_oc"),
                        F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_od"))
    out = local.join(F.broadcast(offs), "_seg")
    for name, method in outputs.items():
        off = F.col("_od") if method == "dense_rank" else F.col("_oc")
        out = out.withColumn(name, F.col(f"_l_{name}").cast("long") + off).drop(f"_l_{name}")
    return out.drop("_seg", "_oc", "_od")


def row_positions(df: DataFrame, order_by, out: str = "pos", segments: int | None = None) -> DataFrame:
    """0-based row position under an explicit order (pandas ``iloc``)."""
    return (global_rank(df, order_by, "row_number", "_rn", segments)
            .withColumn(out, F.col("_rn") - 1).drop("_rn"))


# W19 --------------------------------------------------------------------
def fill_forward(df: DataFrame, order_by, cols: Sequence[str], partition_by=None) -> DataFrame:
    """pandas ``ffill``: last non-NULL value so far, in ``order_by`` order
    (per group when ``partition_by``; ``segmented_fill`` gives the same for
    groups of any size)."""
    if partition_by is None:
        return segmented_fill(df, None, order_by, cols, "forward")
    w = (Window.partitionBy(*_cols(partition_by)).orderBy(*sort_keys(order_by))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in cols:
        df = df.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return df


def fill_backward(df: DataFrame, order_by, cols: Sequence[str], partition_by=None) -> DataFrame:
    """pandas ``bfill``: next non-NULL value, in ``order_by`` order."""
    if partition_by is None:
        return segmented_fill(df, None, order_by, cols, "backward")
    w = (Window.partitionBy(*_cols(partition_by)).orderBy(*sort_keys(order_by))
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    for c in cols:
        df = df.withColumn(c, F.first(c, ignorenulls=True).over(w))
    return df


def segmented_fill(df: DataFrame, partition_by, order_by, cols: Sequence[str],
                   direction: str = "forward", segments: int | None = None) -> DataFrame:
    """Forward/backward fill over ordered segments (no partition key: the
    whole table; with one: hot groups split). Fill inside each
    (group, segment); rows still NULL at a segment's start (end) take the
    last (first) non-NULL value of the same group from earlier (later)
    segments, found in a table of one row per (edge group, segment)."""
    keys = _cols(partition_by)
    okeys = sort_keys(order_by)
    forward = direction == "forward"
    seg = range_segments(df, [*keys, *as_specs(order_by)], segments).withColumn("_gk", _gkey(keys))
    frame = ((Window.unboundedPreceding, Window.currentRow) if forward
             else (Window.currentRow, Window.unboundedFollowing))
    wl = Window.partitionBy("_gk", "_seg").orderBy(*okeys).rowsBetween(*frame)
    pick = F.last if forward else F.first
    local = seg
    for c in cols:
        local = local.withColumn(c, pick(c, ignorenulls=True).over(wl))
    # per (edge group, segment): its last (first) non-NULL value of each column
    edge = seg.join(F.broadcast(_edge_groups(seg)), ["_gk", "_seg"], "left_semi") if keys else seg
    wa = Window.partitionBy("_gk", "_seg").orderBy(*okeys).rowsBetween(Window.unboundedPreceding,
                                                                          Window.unboundedFollowing)
    ends = edge.select("_gk", "_seg", *[pick(c, ignorenulls=True).over(wa).alias(c) for c in cols]).distinct()
    carry_frame = (Window.unboundedPreceding, -1) if forward else (1, Window.unboundedFollowing)
    wc = Window.partitionBy("_gk").orderBy("_seg").rowsBetween(*carry_frame)
    carry = ends.select("_gk", "_seg", *[pick(c, ignorenulls=True).over(wc).alias(f"_carry_{c}") for c in cols])
    out = local.join(F.broadcast(carry), ["_gk", "_seg"], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_carry_{c}")))
    return out.drop("_seg", "_gk", *[f"_carry_{c}" for c in cols])


# W20 --------------------------------------------------------------------
def ledger_balance(df: DataFrame, account_col: str, order_by: Sequence[str],
                   amount_col: str, opening: float = 0.0,
                   balance_col: str = "balance", status_col: str = "status") -> DataFrame:
    """Running balance where a withdrawal (negative amount) larger than the
    current balance is rejected and leaves the balance unchanged.

    Rejection makes the fold stateful, so it is not a running sum. Rows are
    hash-partitioned by account and sorted inside each partition; a fold
    streams through the sorted Arrow batches carrying one balance, so memory
    stays bounded whatever an account's size. Accounts are told apart by a
    key string made in the JVM, so a NULL account is one account and long ids
    stay exact. Stretches without a possible rejection (deposits, and
    withdrawals that the running sum covers) are summed as arrays; only a
    rejection starts a new stretch. Accounts run in parallel; one account's
    rows are a sequential chain by definition and are folded in order inside
    one task.
    """
    schema = T.StructType(df.schema.fields + [
        T.StructField(balance_col, T.DoubleType()),
        T.StructField(status_col, T.StringType())])
    key = F.to_json(F.struct(F.col(account_col).cast("string").alias("k")), {"ignoreNullFields": "false"})
    prepared = (df.select("*", F.col(amount_col).cast("double").alias("__amount"), key.alias("__account"))
                .repartition("__account").sortWithinPartitions("__account", *list(order_by)))
    names = df.columns

    def sweep(amounts, start):
        """``chain`` of a short account, row after row: fewer steps than the
        arrays of a stretch take."""
        balance, rejected = [], []
        for x in amounts.tolist():
            refused = x < 0 and start + x < 0
            start = start if refused else start + x
            balance.append(start)
            rejected.append(refused)
        return balance, rejected

    def chain(amounts, start):
        """Balance after each amount, and which amounts were rejected. A
        stretch begins short after a rejection and doubles without one."""
        if len(amounts) <= 256:
            return sweep(amounts, start)
        balance, rejected, at, width = np.empty(len(amounts)), np.zeros(len(amounts), bool), 0, 32
        while at < len(amounts):
            part = amounts[at:at + width]
            running = np.cumsum(np.r_[start, part])[1:]
            bad = np.flatnonzero((running < 0) & (part < 0))
            stop = int(bad[0]) if len(bad) else len(running)
            balance[at:at + stop] = running[:stop]
            start = float(running[stop - 1]) if stop else start
            at += stop
            width = 32 if len(bad) else min(4096, 2 * width)
            if len(bad):
                balance[at], rejected[at] = start, True
                at += 1
        return balance, rejected

    def fold(batches):
        current, bal = None, opening
        for batch in batches:
            accounts = batch.column(len(names) + 1).to_numpy(zero_copy_only=False)
            amounts = batch.column(len(names)).to_numpy(zero_copy_only=False)
            known = ~np.isnan(amounts)
            edges = np.r_[0, np.flatnonzero(accounts[1:] != accounts[:-1]) + 1, len(accounts)] if len(accounts) else [0]
            filled = np.where(known, amounts, 0.0)
            balance, refused = np.empty(len(accounts)), np.zeros(len(accounts), bool)
            for a, b in zip(edges[:-1], edges[1:]):
                if accounts[a] != current:
                    current, bal = accounts[a], opening
                balance[a:b], refused[a:b] = chain(filled[a:b], bal)
                bal = float(balance[b - 1])
            status = np.select([~known, refused, amounts >= 0], ["skipped", "rejected", "deposit"], "withdrawal")
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(balance), pa.array(status, pa.string())],
                                             [*names, balance_col, status_col])

    return prepared.mapInArrow(fold, schema)
