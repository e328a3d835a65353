"""flowguard: two-stage detection over network-traffic tables and streams, on Spark."""

import sys

from pyspark import cloudpickle

from flowguard.taxonomy import TRAFFIC, Taxonomy

# Functions used inside tasks travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["TRAFFIC", "Taxonomy"]
