"""Operators for large training-data pipelines (text, pages, vectors, chats).

One module per operator; ``queries`` registers them over the given tables.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so the executors need only
# the public libraries and not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
