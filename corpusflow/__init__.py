"""Corpus preparation, byte-level BPE and training-run analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
