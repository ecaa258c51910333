"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.renames import apply_renames, split_renamed


def union_by_name(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def concat_rows(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on one side become NULL."""
    return union_by_name(*frames, allow_missing=True)


def distinct_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def intersection(a: DataFrame, b: DataFrame, all_: bool = False) -> DataFrame:
    """INTERSECT (NULLs compare equal, as in set semantics)."""
    return a.intersectAll(b) if all_ else a.intersect(b)


def difference(a: DataFrame, b: DataFrame, all_: bool = False) -> DataFrame:
    return a.exceptAll(b) if all_ else a.subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).unionByName(b.subtract(a))


def is_subset(a: DataFrame, b: DataFrame) -> bool:
    return a.subtract(b).isEmpty()


def is_disjoint(a: DataFrame, b: DataFrame) -> bool:
    return a.intersect(b).isEmpty()


# U8 ---------------------------------------------------------------------
def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str],
                  op_col: str = "op", order_col: str = "seq",
                  new_key_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply a change set to a keyed table, change after change.

    ``changes`` carries the base columns plus ``op`` and an ordering column.
    Ops: ``i`` insert-or-replace, ``u`` update (only if the key exists at that
    step), ``d`` delete, ``r`` rename the key to ``new_key_col`` (only if the
    key exists and the new one is not NULL; a row there is replaced). Returns
    ``(new_table, rejects)``: rejects are the updates, deletes and renames whose
    key is not present at their step, one row each.

    Without renames the keys do not touch each other. Whether a key exists is
    decided by its last base row, insert or delete, and if it exists, its values
    are those of its last base row, insert or update (an update that came
    before that insert or delete is older): two partial aggregates. Rejects
    carry that existence forward in a window per key. With ``new_key_col`` the
    keys that renames name are resolved by pointer doubling (``renames``): a
    logarithmic number of joins, however long the chains.
    """
    keys = list(keys)
    data = [c for c in base.columns if c not in keys]
    rank = changes.select(*keys, *data, op_col, F.col(order_col).alias("_at"), *([new_key_col] if new_key_col else []))
    if new_key_col:
        if len(keys) != 1:
            raise ValueError("renames need a single key column")
        (alone_base, alone_changes), linked = split_renamed(base, rank, keys[0], op_col, new_key_col)
        table, rejects = apply_changes(alone_base, alone_changes.withColumnRenamed("_at", order_col), keys, op_col, order_col)
        more, more_rejects = apply_renames(*linked, keys[0], data, op_col, new_key_col)
        return table.unionByName(more), rejects.unionByName(more_rejects)
    null_at = F.lit(None).cast(rank.schema["_at"].dataType)
    events = base.select(*keys, *data, F.lit("base").alias(op_col), null_at.alias("_at"), F.lit(0).alias("_late")).unionByName(
        rank.withColumn("_late", F.lit(1)))
    op = F.col(op_col)
    exists = F.when(op.isin("base", "i"), True).when(op == "d", False)
    when = [F.col("_late"), F.col("_at")]
    last = events.groupBy(*keys).agg(
        F.max(F.when(exists.isNotNull(), F.struct(*when, exists.alias("yes")))).alias("_state"),
        F.max(F.when(op.isin("base", "i", "u"), F.struct(*when, *[F.col(c) for c in data]))).alias("_row"))
    table = last.where("_state.yes").select(*keys, *[F.col(f"_row.{c}").alias(c) for c in data])
    before = Window.partitionBy(*keys).orderBy("_late", "_at").rowsBetween(Window.unboundedPreceding, -1)
    known = events.withColumn("_known", F.coalesce(F.last(exists, ignorenulls=True).over(before), F.lit(False)))
    # a rename that gets here has no new key
    return table, known.where((op == "r") | (op.isin("u", "d") & ~F.col("_known"))).select(*keys, op_col)
