"""Operators that prepare text corpora for language-model training.

Each works on a DataFrame shaped like `documents` (doc_id, text, source, ...) or `embeddings`.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
