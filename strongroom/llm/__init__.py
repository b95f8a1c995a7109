"""Operations of a training-data pipeline, each one a Spark job.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.  Every
operator takes a DataFrame and the names of the columns it reads, selects
just those, and returns the id column with its results, so extra columns of
the input, whatever their names, never clash with a result.

Functions that run inside Python workers are shipped by value, so executors
need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
