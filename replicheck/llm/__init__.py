"""Operators for large training-data pipelines: text, web pages, vectors and token mixes.

Nothing outside this package imports it. Functions that run inside tasks are pickled by value,
so executors need numpy and the other installed libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
