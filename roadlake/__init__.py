"""roadlake: a Spark-native medallion pipeline for road-incident records.

Layers (all plain DataFrame / Spark SQL / MLlib):

* ``sources``   – CSV batches, Bronze store, catalog tables, sinks, test adapter
* ``functions`` – column-name cleaning and column expressions
* ``operators`` – Bronze, ordered split, Silver conform, Gold marts, KPIs,
  profiling, features and the severity model
* ``plans``     – end-to-end jobs and the registry of named queries
* ``streaming`` – incremental Bronze ingest with a file-source stream
"""

__version__ = "0.1.0"
