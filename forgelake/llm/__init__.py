"""Training-data operators over documents and embeddings.

Nothing else in the library imports this subpackage.  Its Python functions
travel to executors by value, so a cluster needs no copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
