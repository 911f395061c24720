"""Training-data operators: one module per operator, `queries` registers them.

Functions of this package travel to the Python workers by value, so that it need not be
installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
