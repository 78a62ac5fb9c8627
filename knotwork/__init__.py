"""knotwork: record linkage and data processing as Spark plans.

Functions that run in Python workers travel with their code, so executors need no installation of the package.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

cloudpickle.register_pickle_by_value(sys.modules[__name__])
