"""Operators for cleaning and preparing a text corpus for language-model training.

What tasks run is pickled by value, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
