"""Join operators.

Join strategy is left to Catalyst and AQE (sort-merge by default, runtime
conversion to broadcast from measured shuffle sizes, skew-join splitting).
Explicit broadcasts only happen behind a row-count check, with the shuffle
join as the fallback; the salted join handles hot keys that AQE cannot
split (small builds, outer sides).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators._store import BROADCAST_BYTES, row_bytes, stored, stored_side
from lakeloom.operators.windows import row_positions

# Accepted join type spellings and their Spark names.
JOIN_TYPES = {
    "inner": "inner", "left": "left", "left_outer": "left", "right": "right",
    "right_outer": "right", "full": "full", "outer": "full", "full_outer": "full",
    "left_semi": "left_semi", "semi": "left_semi", "left_anti": "left_anti", "anti": "left_anti",
}


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# J1-J6, J17 -------------------------------------------------------------
def join(left: DataFrame, right: DataFrame, on, how: str = "inner",
         null_safe: bool = False) -> DataFrame:
    """Equi join on shared key names (USING semantics: one key column in
    the output; for full outer joins the key is coalesced).

    ``null_safe=True`` makes NULL keys match each other (pandas ``merge``).
    """
    how = JOIN_TYPES[how]
    keys = _cols(on)
    if how in ("left_semi", "left_anti"):
        # only key existence matters: dedup the right keys first (a partial,
        # map-side aggregate), so a key repeated many times -- or one hot key
        # -- crosses the shuffle once per task instead of once per row
        right = right.select(*keys).distinct()
    if not null_safe:
        return left.join(right, keys, how)
    l, r = left.alias("_l"), right.alias("_r")
    cond = None
    for k in keys:
        c = F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}"))
        cond = c if cond is None else cond & c
    joined = l.join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    key_exprs = [F.coalesce(F.col(f"_l.{k}"), F.col(f"_r.{k}")).alias(k) if how in ("full", "right")
                 else F.col(f"_l.{k}").alias(k) for k in keys]
    rest_l = [F.col(f"_l.{c}") for c in left.columns if c not in keys]
    rest_r = [F.col(f"_r.{c}") for c in right.columns if c not in keys]
    return joined.select(*key_exprs, *rest_l, *rest_r)


def join_on_columns(left: DataFrame, right: DataFrame, left_on, right_on,
                    how: str = "inner", keep_right_keys: bool = False) -> DataFrame:
    """Join on differently named keys (J9); the right key columns are
    dropped unless asked for."""
    lk, rk = _cols(left_on), _cols(right_on)
    cond = None
    for a, b in zip(lk, rk):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    out = left.join(right, cond, JOIN_TYPES[how])
    if not keep_right_keys and JOIN_TYPES[how] not in ("left_semi", "left_anti"):
        for b in rk:
            out = out.drop(right[b])
    return out


# J7 / R4 ----------------------------------------------------------------
#: rows of a row or column block of a product
PRODUCT_BLOCK = 2_000
#: cells that a task of a product works through
PRODUCT_CELLS = 16
#: values that ``packed`` lays side by side in a row, and rows it packs among themselves
PACK_WIDTH, PACK_RANGE = 16, 4_096


def cross_product(left: DataFrame, right: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Cartesian product of tables of any size. A side that is counted to be
    small is broadcast; of two large sides, see ``blocked_product``."""
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    for small, other in ((right, left), (left, right)):
        most = limit // row_bytes(small)
        if most and small.limit(most + 1).count() <= most:
            out = other.crossJoin(F.broadcast(small))
            return out if small is right else out.select(*left.columns, *right.columns)
    return blocked_product(left, right)


def blocked_product(left: DataFrame, right: DataFrame, block: int = PRODUCT_BLOCK) -> DataFrame:
    """Cartesian product by cells: the left rows are dealt to row blocks and the
    right ones to column blocks of about ``block`` rows, in turn (so equal rows
    do not gather), and each (row block, column block) is one key of an equi
    join. A left row goes to every column block once and a right row to every
    row block; no side is broadcast and no task holds more than a cell's rows.
    The tasks are counted from the cells: a cell's work is the square of its
    bytes, so tasks sized by bytes would be few and long."""
    n_rows, n_columns = (max(1, -(-side.count() // block)) for side in (left, right))
    deal = lambda n: F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = left.select("*", deal(n_rows).alias("_row")).select("*", every(n_columns).alias("_column"))
    b = right.select("*", deal(n_columns).alias("_column")).select("*", every(n_rows).alias("_row"))
    cells = n_rows * n_columns
    tasks = min(cells, max(_shuffle_partitions(left), cells // PRODUCT_CELLS))
    a, b = (side.repartition(tasks, "_row", "_column") for side in (a, b))
    return a.join(b.hint("merge"), ["_row", "_column"]).drop("_row", "_column")


def packed(df: DataFrame, keys, value: str, width: int = PACK_WIDTH) -> DataFrame:
    """Rows of equal ``keys`` side by side, at most ``width`` of them a row: the
    keys, ``_n`` (how many they are) and their values in ``{value}_0`` on,
    NULL beyond ``_n``. Aggregates over a product look their group up once a
    row, so with one side packed once for ``width`` pairs. Rows are packed
    within ranges of ``PACK_RANGE`` rows as read, so that no task holds a whole
    key, and stored: a repeated task finds the same packs."""
    keys = _cols(keys)
    # fields in a list, for NULL values too; sorted, so that order of arrival does not matter
    lists = (df.select(*keys, value, F.floor(F.monotonically_increasing_id() / PACK_RANGE).alias("_range"))
             .groupBy(*keys, "_range").agg(F.sort_array(F.collect_list(F.struct(value))).alias("_all")))
    packs = lists.select(*keys, F.explode(F.sequence(F.lit(1), F.size("_all"), F.lit(width))).alias("_at"), "_all") \
        .select(*keys, F.slice("_all", F.col("_at"), width).alias("_some"))
    return stored(packs.select(*keys, F.size("_some").alias("_n"), *[
        F.get("_some", F.lit(i))[value].alias(f"{value}_{i}") for i in range(width)]), "packed")


# J10 / D17 --------------------------------------------------------------
def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else f"{prefix}{c}") for c in df.columns])


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str], str]],
              how: str = "inner") -> DataFrame:
    """Join a fact table to several dimensions in order. Each dimension is
    ``(frame, keys, prefix)``; non-key columns that would clash with columns
    already present are renamed ``prefix + name`` first, so the result never
    holds duplicate names."""
    out = fact
    for dim, keys, prefix in dims:
        keys = _cols(keys)
        present = set(c.lower() for c in out.columns)
        renamed = dim.select(*[F.col(c).alias(f"{prefix}{c}" if (c not in keys and c.lower() in present) else c)
                               for c in dim.columns])
        out = out.join(renamed, keys, JOIN_TYPES[how])
    return out


# J11 --------------------------------------------------------------------
def bounded_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``dim`` with a broadcast hint if it is small: at most as many rows as
    fit ``max_bytes`` are counted (the count stops there). Beyond that the
    frame comes back without a hint and the join shuffles."""
    most = max(1, max_bytes // row_bytes(dim))
    return F.broadcast(dim) if dim.limit(most + 1).count() <= most else dim


def broadcast_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join that broadcasts ``dim`` if it is checked to be small."""
    return fact.join(bounded_broadcast(dim, max_bytes), _cols(on), JOIN_TYPES[how])


# J12 / L6 ---------------------------------------------------------------
def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, min_share: float | None = None) -> list:
    """Keys (NULL too) holding at least ``min_share`` of the rows, by default
    what one shuffle task would hold if rows were even. At most
    ``1 / min_share`` keys can qualify, so the driver-side list is bounded."""
    min_share = min_share or 1.0 / _shuffle_partitions(df)
    counts = stored(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key-counts")  # the only scan of df
    total = counts.agg(F.sum("_n")).first()[0]
    if not total:
        return []
    rows = counts.where(F.col("_n") >= F.lit(min_share * total)).limit(int(1 / min_share) + 1).collect()
    return [r[key] for r in rows]


def salted_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner",
                hot: Sequence | None = None, salt_buckets: int | None = None,
                min_share: float | None = None) -> DataFrame:
    """Equi join that splits hot keys.

    Fact rows of a hot key get a salt ``pmod(xxhash64(row), n)`` (stable
    under task retry, unlike ``rand()``); the matching dimension rows are
    replicated once per salt. Other keys use salt 0 and are not replicated.
    The join is then on ``(key, salt)``, so a hot key is spread over ``n``
    tasks; by default as many as a shuffle has. A hot NULL key is spread as
    well (it joins nothing, but a left join keeps its rows). Supports inner
    and left joins (the fact side is preserved). Which keys are measured as
    hot changes the layout only, never the rows.
    """
    salt_buckets = salt_buckets or _shuffle_partitions(fact)
    if JOIN_TYPES[how] not in ("inner", "left"):
        # replicated dimension rows would repeat unmatched dimension rows
        raise ValueError("salted_join supports inner and left joins (fact side preserved)")
    hot = list(hot) if hot is not None else hot_keys(fact, key, min_share)
    if not hot:
        return fact.join(dim, key, JOIN_TYPES[how])
    is_hot = F.coalesce(F.col(key).isin([k for k in hot if k is not None]), F.lit(None in hot))
    salted_fact = fact.withColumn("_salt", F.when(is_hot, F.pmod(
        F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt_buckets))).otherwise(F.lit(0)))
    salted_dim = dim.withColumn("_salt", F.explode(F.when(
        is_hot, F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))))
    return salted_fact.join(salted_dim, [key, "_salt"], JOIN_TYPES[how]).drop("_salt")


# J13 / J14 --------------------------------------------------------------
def pairs_summing_to(df: DataFrame, value_col: str, target) -> DataFrame:
    """Two-sum over a table: for each value pair ``a <= b`` with
    ``a + b = target``, the number of unordered row pairs ``(i < j)``.

    Counted from value frequencies (an equi join of the per-value counts on
    ``target - a``) rather than by emitting every row pair, so a frequent
    value costs one row, not a quadratic blow-up.
    """
    counts = df.where(F.col(value_col).isNotNull()).groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
    a = counts.select(F.col(value_col).alias("a"), F.col("_n").alias("na"))
    b = counts.select(F.col(value_col).alias("b"), F.col("_n").alias("nb"))
    t = target if isinstance(target, Column) else F.lit(target)
    joined = a.join(b, (F.col("b") == t - F.col("a")) & (F.col("a") <= F.col("b")))
    na, nb = (F.col(c).cast("decimal(19,0)") for c in ("na", "nb"))
    same = F.col("a") == F.col("b")
    twice = na * F.when(same, na - 1).otherwise(nb * 2).cast("decimal(19,0)")  # exact: at most 38 digits
    pairs = F.floor(twice / 2).cast("decimal(38,0)")
    return joined.select("a", "b", pairs.alias("n_pairs")).where(F.col("n_pairs") > 0)


def count_unequal_pairs(df: DataFrame, key: str, by=None) -> DataFrame:
    """Number of ordered row pairs ``(i != j)`` whose keys differ:
    ``n^2 - sum(count_k^2)``, without enumerating pairs."""
    by = [] if by is None else _cols(by)
    per = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("_c"))
    n = F.sum("_c").cast("decimal(19,0)")
    own = F.sum((F.col("_c").cast("decimal(19,0)") * F.col("_c").cast("decimal(19,0)")).cast("decimal(38,0)"))
    return per.groupBy(*by).agg(((n * n).cast("decimal(38,0)") - own).cast("decimal(38,0)").alias("n_pairs"))


# J15 --------------------------------------------------------------------
def join_group_aggregate(df: DataFrame, keys, agg_exprs: Sequence[Column]) -> DataFrame:
    """Attach per-group aggregates to every row (join to an aggregated
    inline view). The aggregate is computed once and stored; its written size
    decides whether it is sent to the rows or both sides are shuffled."""
    keys = _cols(keys)
    return join(df, stored_side(df.groupBy(*keys).agg(*agg_exprs), "group-statistics"), keys, "inner", null_safe=True)


# J16 --------------------------------------------------------------------
def zip_rows(left: DataFrame, right: DataFrame, left_order, right_order) -> DataFrame:
    """Positional side-by-side concat (pandas ``concat(axis=1)``): the i-th
    row of each side under its explicit order; the shorter side is padded
    with NULL. Positions come from the distributed global row number; rows come
    back in no order of their own."""
    lp = row_positions(left, left_order, "_pos")
    rp = row_positions(right, right_order, "_pos")
    return lp.join(rp, "_pos", "full").drop("_pos")
