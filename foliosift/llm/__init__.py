"""Operators for preparing training data at scale; nothing else in the package imports this."""

import sys

from pyspark import cloudpickle

# Python tasks carry these modules with them: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
