"""framecurate: camera-dataset curation on Spark.

Modules: ``functions`` (Column expressions), ``sources`` / ``sinks`` (I/O),
``operators`` (relational building blocks and the per-camera state machine),
``plans`` (end-to-end compositions and the registered queries),
``streaming`` (Structured Streaming forms), ``testdata`` (driver-table adapters).
"""
