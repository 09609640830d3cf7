"""Operators on the documents and pages of a training corpus."""

import sys

from pyspark import cloudpickle

# Tasks get the functions that they run along with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
