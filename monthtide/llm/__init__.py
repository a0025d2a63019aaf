"""Operations of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# The functions that run in the executors travel with the job: no executor needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
