"""Operators for preparing text, page and vector corpora for model training.

Functions that run inside tasks are shipped by value, so executors need only
numpy, pyarrow and the tokenizer libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
