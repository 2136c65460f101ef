"""Multi-tenant event admission, delivery and persistence on Spark DataFrames and streams."""

import sys

from pyspark import cloudpickle

from tidegate.settings import (Capacity, FlushSettings, QuotaPolicy, SampleSettings,
                               TopicSettings)

# Functions that run in Python workers travel with the job, so that the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Capacity", "FlushSettings", "QuotaPolicy", "SampleSettings", "TopicSettings"]
