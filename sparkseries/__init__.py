"""PySpark-native analysis and forecasting of many time series at once.

Every operator takes and returns a DataFrame in long form: a list of series-key columns, one
time column and one or more value columns. Operators are lazy; only functions that say so run
a job.
"""

__version__ = "0.1.0"
