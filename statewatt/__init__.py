"""Spark-native market-opportunity analytics.

``functions``  column expressions (guarded ratios, exact-decimal scores, rules)
``operators``  DataFrame -> DataFrame operators (roll-ups, ramps, ranks, joins)
``sources``    input schemas, readers, writers, run metrics
``plans``      the state-level models composed from the operators
"""

__version__ = "0.1.0"
