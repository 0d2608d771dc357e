"""Training-data operators: ten operators for text corpora, one module each.

``queries.py`` registers them as ``opN_<name>``; ``corpus_pipeline.py`` at the
repository top chains five of them. Functions and models that run on executors
are sent by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
