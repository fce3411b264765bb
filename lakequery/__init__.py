"""SQL results on Spark: capped, chunked, encoded, typed, exported and logged."""

import sys

from pyspark import cloudpickle

# Python code that runs in tasks travels with them, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from lakequery.session import QueryBatch, QueryResult, Session  # noqa: E402

__all__ = ["QueryBatch", "QueryResult", "Session"]
