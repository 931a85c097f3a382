"""Mapping of the driver's tables to vessel tables, and the SQL the results are checked against."""

import sys

from pyspark import cloudpickle

# As in the library: functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
