"""Annotated-raster dataset preparation expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Send the small Arrow functions along with the plan, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
