"""tokenmill: language-model training-data preparation as Spark jobs.

Modules: ``sources`` (shard scans, inventory, sinks), ``functions`` (column
expressions: text splitting, vectors), ``operators`` (vocabulary, BPE
training/encoding/decoding, packing, vector tables), ``plans`` (end-to-end
jobs, registered queries, SQL oracles), ``streaming`` (incremental shards).
"""
__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run on the executors are shipped with their code, so that the
# package need not be installed there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
