"""Training-data operators: fingerprints, duplicates, language, mixing, extraction, quality, tokens, URLs, privacy."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the Python workers with the task, so workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
