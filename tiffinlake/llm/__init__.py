"""Training-data operators: language, toxicity and licence scoring, near-duplicates, fingerprints, search, mixing, shards, tokens.

Every module holds one operator with a general interface; ``queries`` registers one query for each.
The package is pickled by value, so Python workers need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
