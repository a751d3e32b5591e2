"""stepwise: ordered e-commerce funnel analytics on Spark DataFrames.

Layers (each a function from DataFrames to a DataFrame, composed lazily so
Catalyst sees one plan per mart):

* ``sources``    raw event schema, sharded parquet reader, test-table adapter,
                 CSV export sink
* ``functions``  column expressions (param lookup, channel and category rules,
                 safe division, tiers, friction texts)
* ``operators``  staging (flatten events and items), the ordered funnel,
                 joins that adaptive execution can split
* ``plans``      marts: funnel summary, revenue leakage, friction score,
                 category and channel x device performance, profiling, quality
                 checks, and the query catalog
"""

from stepwise.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
