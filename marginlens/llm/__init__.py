"""Training-data operators: packing, fingerprints, joins, archives, extraction,
chat formatting, line dedup, mixing, nearest neighbours and quality.

Nothing else in the library imports this subpackage.  Its modules are pickled
by value, so the Python helpers of its operators travel with each task and
executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
