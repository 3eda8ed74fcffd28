"""Linear-referenced road data, conflation and transit analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

#: Functions sent to executors carry their code, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
