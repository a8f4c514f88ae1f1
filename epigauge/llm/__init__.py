"""Operators for preparing training text at scale; nothing else in the package depends on them.

Their Python functions travel with the job, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
