"""quern: everyday analytics jobs written with PySpark DataFrames, MLlib and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the job, so that it need not be
# installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
