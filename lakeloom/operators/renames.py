"""Change sets that rename keys (U8), resolved by pointer doubling.

Every event touches one key, a rename two. A touch is a node: the state of its
key right after the event. A row that is there after a node goes on to one node
at most: the next touch of its key, or, if that touch renames the key, the
touch of the new key. So rows run along a forest of pointers:

* which nodes hold a row: those that a base row or an insert reaches. Marks are
  sent along pointers of length 1, 2, 4, ...;
* whose values they hold: an update starts new values, a rename that arrives
  replaces those of the row that was there. What is left are paths without
  branches; doubling their back pointers finds each path's first node.

Rounds grow with the logarithm of the longest run of events on one row, not
with its length, and each round is joins on node numbers that are unique on one
side at least: a key in a third of all events is no hot key in them. Neighbours
within a key are found in ordered segments, so such a key is cut there too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators._store import stored, stored_side
from lakeloom.operators.windows import segmented_lead_lag

#: kinds of touches: values start here; the row goes on; the key is left
STARTS, GOES_ON, LEAVES = ("set", "update"), ("arrive", "same", "void"), ("delete", "move")


def split_renamed(base: DataFrame, changes: DataFrame, key: str, op_col: str, new_key_col: str):
    """(base, changes) of the keys that no valid rename names, and (base,
    changes) of the others."""
    renames = changes.where((F.col(op_col) == "r") & F.col(new_key_col).isNotNull())
    named = renames.select(F.explode(F.array(key, new_key_col)).alias("_named")).distinct()
    named = stored_side(named, "renamed-keys")

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.join(named, df[key].eqNullSafe(named["_named"]), how)

    return (part(base, "left_anti"), part(changes, "left_anti")), (part(base, "left_semi"), part(changes, "left_semi"))


def _events(base: DataFrame, changes: DataFrame, key: str, data: list[str], op_col: str, new_key_col: str) -> DataFrame:
    """e (number), k, op, late, at, new, row of base rows (one a key, the last
    by its values) and changes."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(data)], F.lit(0).alias("end"))
    nothing = lambda c: F.lit(None).cast(changes.schema[c].dataType)
    first = base.groupBy(F.col(key).alias("k")).agg(F.max(row).alias("row")).select(
        "k", F.lit("base").alias("op"), F.lit(0).alias("late"), nothing("_at").alias("at"), nothing(new_key_col).alias("new"), "row")
    later = changes.where(F.col(op_col).isin("i", "u", "d", "r")).select(
        F.col(key).alias("k"), F.col(op_col).alias("op"), F.lit(1).alias("late"), F.col("_at").alias("at"), F.col(new_key_col).alias("new"), row.alias("row"))
    return stored(first.unionByName(later).withColumn("e", F.monotonically_increasing_id()), "rename-events")


def _touches(events: DataFrame) -> DataFrame:
    """id, k, kind, next (id and kind of the next touch of the key), goes (the
    node that a row here goes on to). An event ``e`` has the nodes ``2 e`` and,
    for the new key of a rename, ``2 e + 1``."""
    op, new = F.col("op"), F.col("new")
    kind = (F.when(op.isin("base", "i"), "set").when(op == "u", "update").when(op == "d", "delete")
            .when(new.isNull(), "void").when(new.eqNullSafe(F.col("k")), "same").otherwise("move"))
    own = events.select((F.col("e") * 2).alias("id"), "k", "late", "at", kind.alias("kind"), "new")
    to = own.where("kind = 'move'").select((F.col("id") + 1).alias("id"), F.col("new").alias("k"), "late", "at", F.lit("arrive").alias("kind"))
    both = own.drop("new").unionByName(to).withColumn("me", F.struct("id", "kind"))
    out = segmented_lead_lag(both, "k", ["late", "at", "id"], "me", lead_name="next")
    after = F.col("next.kind")
    goes = F.when(after.isin("update", *GOES_ON), F.col("next.id")).when(after == "move", F.col("next.id") + 1)
    return stored(out.select("id", "k", "kind", "next", F.when(~F.col("kind").isin(*LEAVES), goes).alias("goes")), "rename-touches")


def _reached(touches: DataFrame) -> DataFrame:
    """Numbers of the nodes that a row gets to."""
    marks = touches.where("kind = 'set'").select("id")
    ahead = touches.where("goes is not null").select("id", F.col("goes").alias("p"))
    while not ahead.isEmpty():
        marks = stored(marks.unionByName(marks.join(ahead, "id").select(F.col("p").alias("id"))).distinct(), "rename-marks")
        ahead = stored(ahead.join(ahead.select(F.col("id").alias("p"), F.col("p").alias("q")), "p").select("id", F.col("q").alias("p")), "rename-ahead")
    return marks


def _sources(live: DataFrame) -> DataFrame:
    """id, p: for each live node that only passes a row on, the node where the
    row's values start. A renamed row wins over the one it finds."""
    starts: Column = F.col("kind").isin(*STARTS)
    arrives = F.col("next.kind") == "move"
    edges = live.where(F.col("goes").isNotNull() & (F.col("next.kind") != "update")).select(
        F.col("goes").alias("id"), F.struct(arrives.alias("renamed"), F.col("id").alias("p"), starts.alias("done")).alias("from"))
    back = stored(edges.groupBy("id").agg(F.max("from").alias("from")).select("id", "from.p", "from.done"), "rename-back")
    while not back.where("not done").isEmpty():
        further = back.select(F.col("id").alias("p"), F.col("p").alias("q"), F.col("done").alias("there"))
        moved = back.where("not done").join(further, "p").select("id", F.col("q").alias("p"), F.col("there").alias("done"))
        back = stored(back.where("done").unionByName(moved), "rename-back")
    return back.select("id", "p")


def apply_renames(base: DataFrame, changes: DataFrame, key: str, data: list[str],
                  op_col: str, new_key_col: str) -> tuple[DataFrame, DataFrame]:
    """(new table, rejects) after all ``changes`` (with ``_at``, their order) in
    turn. NULL is a key like others; an unknown op is no event; events with
    equal ``_at`` get some order that is kept throughout."""
    events = _events(base, changes, key, data, op_col, new_key_col)
    touches = _touches(events)
    live = stored(touches.join(_reached(touches), "id", "left_semi"), "rename-live")
    last = live.where("next is null").join(_sources(live), "id", "left").select(
        "k", F.shiftright(F.coalesce("p", "id"), 1).alias("e"))
    table = last.join(events.select("e", "row"), "e").select(
        F.col("k").alias(key), *[F.col(f"row.d{i}").alias(c) for i, c in enumerate(data)])
    done = live.where("next is not null").select("next.id")
    needs_row = touches.where(F.col("kind").isin("update", "same", *LEAVES)).join(done, "id", "left_anti")
    name = F.when(F.col("kind") == "update", "u").when(F.col("kind") == "delete", "d").otherwise("r")
    rejects = needs_row.unionByName(touches.where("kind = 'void'")).select(F.col("k").alias(key), name.alias(op_col))
    return table, rejects
