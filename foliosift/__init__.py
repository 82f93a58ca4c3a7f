"""Curating text corpora and annotated instruction data with Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run on executors travel with the job, so that
# executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
