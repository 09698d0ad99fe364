"""Operators that prepare text and vectors for training language models.

Nothing outside this folder imports it. Functions that run in tasks travel with the job, so executors
need the libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
