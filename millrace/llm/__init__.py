"""Operators for preparing language-model training data.

Functions that run inside tasks travel with the job by value, so executors need no copy of this
package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
