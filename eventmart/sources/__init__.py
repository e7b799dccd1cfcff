"""Sources: delimited event files, the partitioned lake, and driver-table adapters."""
