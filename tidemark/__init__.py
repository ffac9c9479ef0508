"""tidemark: analytics jobs for an online business, written on Spark DataFrames.

Sub-packages
------------
sources    table contracts, driver-table adapters, layouts, generators
functions  column helpers (dates, money, rounding, hashing)
operators  the jobs: commerce, activity, work queue, inventory, quality, availability
plans      registered queries with their SQL oracles, broadcast guards, chunked ordered scans
streaming  Structured Streaming forms of the event-shaped jobs
"""

__version__ = "0.1.0"
