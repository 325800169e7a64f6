"""Operators that prepare a corpus for training language models.

Each module holds one operator with a general interface; ``queries`` applies them to the
test tables. Nothing else in the library imports this package.

Functions that run in Spark's Python workers travel with their tasks, so executors need
this package neither installed nor on a path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
