"""The query catalogue over the driver's tables, and the SQL that each query is held against."""
