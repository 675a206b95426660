"""Operators for preparing language-model training data, as Spark jobs.

Each module holds one operator; ``queries`` holds the thin queries over the
driver tables. Nothing else in the library imports this package.

Functions that run inside Python tasks are pickled by value, so executors need
numpy and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
