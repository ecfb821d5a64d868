"""ledgerlark: claims audit, hourly forecasting and agent telemetry on Spark.

Sub-packages
------------
functions   Column -> Column expressions (text, dates, money)
operators   DataFrame -> DataFrame operators (dedup, joins, rules, ...)
sources     readers, writers, lookups and page parsing
plans       the audit warehouse and the forecasting jobs, composed of operators
streaming   the summary tables kept by Structured Streaming
queries     named queries over the shared tables, each with its SQL counterpart
"""

__version__ = "0.1.0"
