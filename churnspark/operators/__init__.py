"""Table operators: profiling, grouping, ranking, preparation, models, segments."""

import sys

from pyspark import cloudpickle

# The few numpy helpers travel with their tasks, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
