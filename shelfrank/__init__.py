"""shelfrank: revenue-aware top-k recommendation analytics on Spark.

Every operator takes and returns Spark DataFrames; the driver only ever holds
small model parameters (weights, a few scalars), never per-user or per-pair
rows.
"""

import sys as _sys

try:  # ship the package's functions with the tasks: executors need no install
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: rely on --py-files / addPyFile
    pass

from shelfrank.session import get_spark, checkpoint_dir  # noqa: E402,F401

__all__ = ["get_spark", "checkpoint_dir"]
