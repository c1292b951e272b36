"""Fixed-delay restarts of a streaming query."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def run_with_restarts(
    writer: Callable[[], DataStreamWriter], attempts: int = 10, delay_seconds: float = 5.0
) -> StreamingQuery:
    """Run a query to its end; after a failure start it again from its checkpoint, up to ``attempts`` times."""
    for attempt in range(attempts + 1):
        query = writer().start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if attempt == attempts:
                raise
            time.sleep(delay_seconds)
    raise AssertionError("unreachable")
