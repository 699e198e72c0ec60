"""Operators for large text corpora: near copies, filters, decontamination, mixing, scoring.

Nothing outside this package imports it.  Each module states what its operator does with
nulls, empty texts, ties, repeated rows and empty tables.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Spark's tasks travel whole, so that workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
