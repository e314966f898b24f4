"""flowkit: moving, cleaning and checking tables with PySpark.

Every operator is a function over DataFrames or Columns.  Functions run no Spark action unless their
docstring says so (sinks, staged writes and bounded one-row aggregates).
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
