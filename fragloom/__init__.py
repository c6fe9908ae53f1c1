"""A Spark-native engine that turns person fragments into curated records.

``functions`` are column expressions, ``operators`` DataFrame transformations, ``sources`` readers
and writers, ``plans`` whole jobs and the query API, ``streaming`` the incremental form.

Functions that run on executors are pickled by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
