"""Training-data operators: one module per operator, plus ``queries`` (the
registered queries and their SQL).  Nothing outside this package imports it.

Functions that run inside tasks travel by value, so executors need no copy of
this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
