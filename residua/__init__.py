"""Spark-native anomaly detection for large labelled record tables and streams."""

import sys

from pyspark import cloudpickle

from residua.roles import Roles
from residua.session import build_session

# Functions sent to executors carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Roles", "build_session"]
