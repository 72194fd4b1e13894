"""Operators for preparing training data. Nothing else in the package imports them.

Their functions travel with the job, so executors need not have this package installed.
"""

from pyspark import cloudpickle

import playbill

cloudpickle.register_pickle_by_value(playbill)
