"""Operations of a training-data pipeline. Nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder go to the workers by value, so that these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
