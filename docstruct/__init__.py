"""docstruct: Spark-native document-structure extraction and corpus operators."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions of it travel with the tasks that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
