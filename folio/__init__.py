"""folio: analytics and classification of labelled text collections on Spark."""

import sys

from pyspark import cloudpickle

# Python functions travel with the query, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
