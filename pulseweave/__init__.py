"""pulseweave: Spark-native analytics over keyed sensor time series.

Every operator is a function from DataFrame to DataFrame.  See the README for
the map of the package.
"""

import sys

from pyspark import cloudpickle

from pulseweave.session import build_session, shared_dir, use_utc

# Python workers get the scan functions with the task, so executors need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "shared_dir", "use_utc"]
