"""Operators of a training-data pipeline: filters, near-duplicates, search, mixing, tokens, archives.

Nothing outside this package imports it. Its functions travel to the executors with
the jobs that use them, so the executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
