"""Operators of a training-data pipeline: tokenizing, chat formatting, scans, dedup, filtering.

Functions of this package that run on executors are sent by value, so the
executors need Python and the libraries, but no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
