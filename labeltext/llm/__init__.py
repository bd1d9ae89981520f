"""Operators for preparing training text; nothing else in the library imports this.

Functions that run in workers are shipped with the job, so the executors need
numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
