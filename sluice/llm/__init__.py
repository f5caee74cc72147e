"""Operators that prepare training text at scale.

Code that runs inside tasks travels with the plan: functions of this package are
pickled by value, so executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
