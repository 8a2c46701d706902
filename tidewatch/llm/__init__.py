"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions that run inside tasks are shipped with the job, so executors need the libraries
they use but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
