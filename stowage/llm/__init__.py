"""Operators of a training-data pipeline: documents, vectors and pages in, decisions and packed sequences out.

Nothing else in the library imports this package. Its functions travel to executors by value, so that
executors need numpy, pyarrow and the named codecs, but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
