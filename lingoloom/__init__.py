"""Corpus curation and transliteration on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, which then need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
