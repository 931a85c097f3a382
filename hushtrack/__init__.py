"""Reporting-gap analytics for vessel position messages, written for Spark."""

import sys

from pyspark import cloudpickle

# Ship the functions behind the Arrow UDFs with the task, so that executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
