"""Training-data operators: thirteen corpus operators and the queries that apply them.

Nothing else in the library imports this package; ``__spark_entry__`` adds its queries
when it can be imported. Every operator takes a DataFrame and column names, selects only
the columns it needs under internal names (so extra or clashing columns do no harm), and
returns a DataFrame.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python workers travel by value: executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
