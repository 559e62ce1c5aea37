"""Daily-active-device analytics on PySpark.

Everything is a ``DataFrame -> DataFrame`` function.  Dates, zones and paths
are arguments; nothing in the package collects data-sized results.
"""

__version__ = "0.1.0"
