"""stowage: a versioned catalog of large file collections, kept with Spark DataFrames.

Sub-packages
------------
functions   Column builders: paths, fingerprints, durations, states, predicates, documents
sources     readers and writers: listings, job snapshots, catalog tables, processing rules
operators   DataFrame -> DataFrame operators: diff, rollups, versions, work, jobs, outputs
plans       whole passes built from operators: indexing, scheduling
streaming   the same operators over event streams
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions travel to executors by value, so that these need not have the package.
register_pickle_by_value(sys.modules[__name__])

__version__ = "0.2.0"
