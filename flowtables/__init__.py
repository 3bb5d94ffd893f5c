"""Message logs, queues, files and semi-structured feeds as Spark tables.

Every operator is a plain function from DataFrames to DataFrames, so it fits
``df.transform``.  Operators that need an order take a ``key`` and an ``order``
and stay correct and balanced when one key holds most of the rows (see
:mod:`flowtables.plans.ordered`).
"""

import sys

from pyspark import cloudpickle

# Python tasks carry our helper functions by value, so executors need no copy
# of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
