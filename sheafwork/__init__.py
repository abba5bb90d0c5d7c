"""Specimen-image dataset building on Spark: functions from DataFrame to DataFrame.

Sub-packages: ``functions`` (column expressions), ``sources`` and ``sinks`` (files in and out),
``operators`` (joins, aggregations, ordered work), ``plans`` (whole jobs) and ``streaming``.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions travel with the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
