"""Incident-ticket analytics on Spark: clean text, find near-duplicate tickets, report on the clusters."""

import sys

from pyspark import cloudpickle

# batch functions travel to the executors with their code, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
