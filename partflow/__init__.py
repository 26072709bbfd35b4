"""partflow: keep large partitioned datasets correct, current and documented, on Spark.

Layout
------
``functions``  column expressions (keys, text, JSON documents)
``sources``    inventory and reads of partitioned parquet and landed documents
``operators``  DataFrame -> DataFrame building blocks, lazy and free of actions
``sinks``      partition publishing, snapshots, the append-only ledger, manifests
``plans``      whole jobs composed of the above
``streaming``  incremental discovery of new partitions
``catalogue``  the queries checked against an SQL oracle
"""
