"""Operators for large text corpora: search, deduplication, scoring, filtering, encoding.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; Spark partitions and shuffles the work, and numpy or a codec
library only handles one bounded batch of rows inside a task.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their tasks, so executors need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
