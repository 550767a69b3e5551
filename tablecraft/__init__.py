"""tablecraft: analytical SQL patterns as PySpark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame.  Planning, shuffling
and execution stay with Spark; the helpers in :mod:`tablecraft.plans` only shape
the work so that one very large group never lands in a single task.
"""

__version__ = "0.1.0"
