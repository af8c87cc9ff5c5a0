"""Operators for preparing training data; nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# functions of this package travel with the plan, so executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
