"""PySpark library for vehicle telemetry: land feeds, refine, enrich, check and report.

Every function takes and returns DataFrames (or Column expressions); paths, column
names and the clock are parameters.  Nothing here uses a Python UDF.
"""
