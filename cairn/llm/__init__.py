"""Operators of a training-data pipeline over documents, conversations and embeddings.

One module per operator; ``graph`` (buckets, components) and ``words`` (hashed words of Arrow batches) are shared
by them. Nothing else in the library imports this subpackage. Functions that run in tasks are shipped by value,
so executors do not need the package installed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
