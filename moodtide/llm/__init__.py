"""Operators that prepare text, page and vector corpora for training.

What their Python functions need goes to the executors with the functions themselves, so that no
executor has to have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
