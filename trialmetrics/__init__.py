"""Online-experiment metrics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from trialmetrics.experiment import Experiment
from trialmetrics.sources.tables import Tables

# The few Python functions that run in tasks travel with them, so that executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Experiment", "Tables"]
