"""graphshed: geospatial change data on Spark.

A node / way / relation graph and its numbered change files are DataFrames;
boxes, polygon splits, store updates and checks are joins, windows and
aggregations over them.
"""
