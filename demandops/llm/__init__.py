"""Training-data operators: ten corpus operators for text at scale.

Each module holds one operator with its own general interface; ``queries``
registers the digest queries (``opN_<name>``) and ``oracle`` their DuckDB
twins.  Nothing outside this subpackage imports it, except the guarded
registration in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel by value: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
