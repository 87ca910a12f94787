"""Training-data operators: dedup, sharding, tokens, secrets, mixing, personal data, toxicity, quality.

Nothing else in the library imports this package. Its Python functions are
shipped to executors by value, so executors need not have the package
installed (numpy, pyarrow, regex and xxhash they do need).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
