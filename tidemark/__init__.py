"""tidemark: Spark-native as-of analytics for keyed daily price series.

Layers: ``sources`` (bindings, readers, snapshots) -> ``plans`` (staging,
universe, metrics, rankings, serving, gates) built from ``operators`` and
``functions``; ``sinks`` write the tables; ``streaming`` feeds incremental
loads. ``catalog.QUERIES`` lists every registered query.
"""

__version__ = "0.1.0"
