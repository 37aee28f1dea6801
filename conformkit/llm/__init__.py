"""Operators of a training-data pipeline over document, embedding, page and
conversation tables.

Nothing else in the library imports this subpackage.  Functions that run in
Python tasks are shipped by value, so executors need only numpy, pyarrow and
(for packing) ``tokenizers``, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
