"""Training-data operators: token counts, SentencePiece, quality, language, dedup, chat, URLs.

Nothing else in the library imports this package. Each module holds one
operator with a general interface; :mod:`basketry.llm.queries` registers one
query per operator over the test tables.
"""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, so the cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
