"""DataFrame operators for survey and mapping data on Spark.

Every operator takes and returns DataFrames.  Packages:

* ``core``       checkpoints, hot-key salting, exact quantiles, numbering, grid joins
* ``functions``  column expressions (text, dates, geometry, projection, colour)
* ``operators``  DataFrame -> DataFrame operators
* ``sources``    readers and writers
* ``streaming``  incremental runs over new files
* ``plans``      registered queries over the given tables, each with its SQL twin
"""
