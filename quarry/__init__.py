"""quarry: quote-to-order reporting, expressed as Spark DataFrame and Structured Streaming jobs.

Functions that run inside Python workers are pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
