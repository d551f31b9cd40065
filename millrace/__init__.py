"""Analytics jobs on tables and streams, written for Spark."""

import sys

from pyspark import cloudpickle

from millrace.session import build_session, prepare, work_dir

# Functions that run in Python workers travel with the job, so that executors
# do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "prepare", "work_dir"]
