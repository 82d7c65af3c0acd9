"""netsift: network-log analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; thresholds are
keyword arguments.  Log columns use underscores (``id_orig_h``), timestamps
are ``timestamp`` in UTC, intervals are seconds.
"""

import sys

from pyspark import cloudpickle

from netsift.session import local_session, prepare

# task functions travel with the job, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["local_session", "prepare"]
