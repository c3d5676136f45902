"""Spark-native engine that turns raw security logs into one queryable corpus."""

import sys

from pyspark import cloudpickle

from logstrata.session import configure

# Helpers that run inside Python workers travel with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure"]
