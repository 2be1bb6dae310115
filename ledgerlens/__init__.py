"""ledgerlens: statement-audit analytics as plain Spark jobs.

Every public operator takes DataFrames and returns a lazy DataFrame; nothing here runs a job
on import, and nothing collects data to the driver unless its docstring says so.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their tasks, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
