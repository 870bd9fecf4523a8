"""captally: caption evaluation and training-data preparation on Spark.

Every public function takes and returns Spark DataFrames.  Nothing in the
core collects data to the driver; see README.md for the design notes.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel with the job, by value: workers need
# neither this package on their path nor a --py-files archive.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
