"""Training-data operators: one module per operator, ``registry`` lists their queries.

Nothing else in the library imports this subpackage. Its functions travel to executors by value,
so the cluster needs the installed libraries but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
