"""Operators for preparing large text corpora: tokenising, packing, deduplication, cleaning.

Nothing outside this package imports it. Functions that run in Python workers are pickled by
value, so a cluster needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
