"""orrery: Spark-native preparation, profiling, learning and scoring of
labelled measurement catalogs (wide tables of per-object measurements).

Every public function maps DataFrame(s) + keyword parameters to a DataFrame
(or a fitted Spark ML model) and keeps the work on the cluster.
"""

__version__ = "0.1.0"
