"""lakeloom: Spark-native analytics building blocks.

Everything here is a function ``DataFrame -> DataFrame`` or
``Column -> Column`` built from Spark SQL / DataFrame expressions, so
Catalyst can push filters down, prune columns and pick join strategies.
Subpackages:

* ``lakeloom.sources``   readers, writers, JDBC ingest, catalog helpers
* ``lakeloom.functions`` column expression builders (strings, dates, math,
  collections, null handling, masking)
* ``lakeloom.operators`` table operators (joins, aggregates, windows, set
  operations, reshape, quality checks, layout)
* ``lakeloom.plans``     named reports and the bronze/silver/gold flow
* ``lakeloom.streaming`` incremental bronze ingestion with Structured Streaming
"""

from lakeloom.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
