"""Job-posting integration and analytics on PySpark.

Every public operator takes DataFrames and returns a DataFrame; nothing reads
the wall clock (``run_ts`` is always an argument) and nothing collects data to
the driver.  Sessions are expected to run with ``spark.sql.session.timeZone``
set to ``UTC`` (see :mod:`hirestream.session`).
"""

__version__ = "0.1.0"
