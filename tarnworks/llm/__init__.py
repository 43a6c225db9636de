"""Operators for training-data pipelines: mixing, sharding, scoring, deduplication, packing.

Functions that run in tasks travel with the job, so executors need no copy of this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
