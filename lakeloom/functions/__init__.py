"""Column expression builders: every function maps Columns to a Column.

They compile to Catalyst expressions (no Python UDFs), so they stay inside
whole-stage code generation and can be pushed down where Spark allows.
"""

from lakeloom.functions import (collections, conditional, dates, math,
                                nulls, privacy, strings, udfs)

__all__ = ["collections", "conditional", "dates", "math", "nulls",
           "privacy", "strings", "udfs"]
