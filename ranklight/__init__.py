"""ranklight: ranked text retrieval and vector search expressed as Spark DataFrame plans.

Sub-packages
- ``functions``  Column-level building blocks (tokeniser, weights, vector maths, formatting).
- ``sources``    readers and writers (corpus tables, stop lists, saved indexes, feature tables, models).
- ``operators``  composite operators (index build, cosine / BM25 search, kNN / range search, features, PCA).
- ``plans``      the registered whole-table queries and their DuckDB twins.
- ``streaming``  a Structured Streaming front end that answers query files as they arrive.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python workers (the distance kernel) are shipped with the task
# by value, so executors need no installed copy of this package (no --py-files, no shared path).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from ranklight.session import get_session, checkpoint_dir  # noqa: E402,F401

__version__ = "0.1.0"
