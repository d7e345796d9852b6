"""Ticket-order analytics as PySpark DataFrame and Structured Streaming jobs.

``functions``  column expressions (no DataFrame, no action)
``sources``    scans: files, catalog, JDBC, Kafka, socket
``operators``  DataFrame -> DataFrame steps; the same body serves batch and stream
``streaming``  starting, sinking and stopping streams, idle-timeout state
``plans``      the registered queries on the test tables and their SQL oracles
"""
