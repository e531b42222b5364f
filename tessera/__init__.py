"""tessera: a Spark-native text retrieval and corpus analytics library.

Everything is expressed as DataFrame / Spark SQL plans over long tables:
documents -> tokens -> term statistics -> postings / vectors -> ranked top-k,
plus corpus counting at several grouping levels and language-model dataset
preparation.  No driver-side collection of data; results are deterministic.
"""

from tessera.session import get_spark, checkpoint_dir, materialize

__all__ = ["get_spark", "checkpoint_dir", "materialize"]

import sys

from pyspark import cloudpickle

# Python functions of the package travel to the workers by value: executors
# need NumPy, pandas and Arrow, but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
