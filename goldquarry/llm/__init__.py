"""Operators of a training-data pipeline, their catalogue queries and their SQL.

Nothing else in the library imports this subpackage.
"""

from pyspark import cloudpickle

import goldquarry

# Functions that run in Python workers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(goldquarry)
