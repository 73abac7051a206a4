"""Operators for building training corpora.

One module per operator, each a function from DataFrames to DataFrames;
``queries`` registers one query per operator, ``oracle`` holds the SQL of
those that SQL can express.  Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors don't
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
