"""areapanel: area-level statistics on Spark.

Layers:
* ``functions``  Column -> Column expressions (name keys, ratios, month arithmetic, HTML anchors)
* ``operators``  DataFrame -> DataFrame steps (checks, columns, joins, grouped sums, time series,
                 spatial overlap, features, models)
* ``sources`` / ``sinks``  readers and table writers
* ``plans``      whole jobs, served views, and the registered test-table queries
"""

__version__ = "0.1.0"
