"""Small results that are computed once and read several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: most bytes (rows times an estimate of their width) that are broadcast
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> int:
    """Bytes a row takes by its types: 8 for fixed widths, 40 for others."""
    wide = ("string", "binary", "array", "map", "struct")
    return 16 + sum(40 if f.dataType.simpleString().startswith(wide) else 8 for f in df.schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder in the shared checkpoint folder and read
    back: it is computed once, survives lost executors, and its size is known."""
    from lakeloom.session import checkpoint_dir
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table with a broadcast hint if its rows (counted from the file
    footers) fit ``max_bytes``; else without, and the join shuffles."""
    return F.broadcast(table) if table.count() * row_bytes(table) <= max_bytes else table


def stored_side(df: DataFrame, name: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """An aggregate stored once and made ready to be joined back."""
    return small_side(stored(df, name), max_bytes)
