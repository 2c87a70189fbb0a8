"""Training-data operators: mixing, near-duplicates, WARC, language ID, secret
scans, decontamination, sharding, suffix-array dedup and URL filters.

Nothing else in the library imports this subpackage.  Its functions are
pickled by value, so executors need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
