"""eventmart: a clickstream analytics warehouse on Spark.

Layers (each a plain module of DataFrame -> DataFrame functions):

* ``sources``   – delimited-text event scan, partitioned lake scan, table adapters
* ``functions`` – column expressions shared by every layer (rounding, coercion, labels)
* ``operators`` – ETL, map/reduce, the seven analytics jobs, marts, report, sinks
* ``plans``     – the named SQL queries and the run-all driver
* ``streaming`` – the same ETL driven incrementally by a file-arrival stream
"""

__version__ = "0.1.0"
