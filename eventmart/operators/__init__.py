"""Operators: ETL, map/reduce, analytics jobs, marts, report, sinks."""
