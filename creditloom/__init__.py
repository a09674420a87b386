"""creditloom: a credit-risk data mart written as composable Spark jobs.

Operators take DataFrames and return lazy DataFrames.  Only ``plans`` and the sink helpers write, and the only
values that ever travel to the driver are fitted statistics of a size bounded by a parameter.
"""
