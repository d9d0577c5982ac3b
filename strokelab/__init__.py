"""Label analytics for timed performance events, and operators for large corpora, on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
