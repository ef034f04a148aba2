"""Training-data operators (numbered as dealt); see ``registry``."""

import sys

from pyspark import cloudpickle

# The functions of this package travel with their tasks, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
