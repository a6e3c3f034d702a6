"""Operators for preparing training text; nothing else in the library imports this package.

Functions that run in tasks travel with the job, so executors need numpy and the
libraries an operator names, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
