"""Incremental reading of the raw layer.

The reference has no streams: freshness is the daily raw folder. This module
only offers the raw folders as a Structured Streaming file source, so a caller
can pick up newly landed days incrementally (``trigger(availableNow=True)``)
instead of re-listing every day; the cleaning itself is the batch silver code.
"""

from almacen.streaming.raw import raw_stream, typed_increments  # noqa: F401
