"""Preparation, training, scoring and telemetry of labelled images and audio on Spark.

Functions shipped to executors are pickled by value, so the package does not
have to be installed on the workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
