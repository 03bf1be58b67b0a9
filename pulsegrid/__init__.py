"""Device telemetry analytics on PySpark.

Pure DataFrame functions that run unchanged on batch tables and on
Structured Streaming: decode keyed JSON messages, validate readings against
device metadata, drop duplicates, aggregate per time window and derive
alive-to-dead device sessions.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python tasks (``mapInPandas``, ``applyInPandasWithState``) must find
    this package's functions on every worker. Pickling the package by value
    sends them with the task, so workers need no install or path setup."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
