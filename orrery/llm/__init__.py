"""Training-data operators (mixing, quality, language models, packing,
near-duplicates, URL and licence filters).

Nothing else in the library imports this subpackage. Functions that run in
Python workers are pickled by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
