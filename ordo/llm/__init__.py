"""Training-data operators: secret scan, mixing, packing, quality model, licence
scan, exact top-k, sketches, near-dedup, sharding and archive fixity.

Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
