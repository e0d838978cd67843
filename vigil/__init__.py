"""vigil: data-quality checks, scoring, profiling and outlier detection as
plain PySpark DataFrame jobs.

Every public function takes and returns DataFrames (or, for one-row
statistics, plain Python values). Nothing passes whole tables through the
driver.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from vigil.session import get_spark, scratch_dir

# The pandas UDFs (tree growth, scoring) are defined in this package. Pickle
# its functions by value so executors need no installed copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["get_spark", "scratch_dir"]
