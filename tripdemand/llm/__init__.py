"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE_SQL`` hold what ``__spark_entry__`` registers.

Functions that run inside tasks travel by value, so the executors' Python
needs pyspark, numpy and pandas but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
