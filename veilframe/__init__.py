"""veilframe: de-identification and text-corpus operators as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Arrow functions carry their helpers with them, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
