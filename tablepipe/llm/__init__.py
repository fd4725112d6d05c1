"""Training-data operators (packing, licences, mixing, HTML, search, quality,
exact and near duplicates, WARC, fingerprints).

Nothing else in the library imports this subpackage.  Its task functions are
shipped by value, so only the driver needs the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
