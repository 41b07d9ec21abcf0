"""pageatlas: a Spark-first engine for archives of periodically re-crawled personal pages."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with their code: nothing needs installing there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
