"""Table operators: ``DataFrame -> DataFrame``."""

from lakeloom.operators import (aggregates, joins, layout, nulls, ordering,
                                projection, quality, quantiles, reshape,
                                setops, windows)

__all__ = ["aggregates", "joins", "layout", "nulls", "ordering", "projection",
           "quality", "quantiles", "reshape", "setops", "windows"]
