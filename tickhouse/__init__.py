"""tickhouse: market-data analytics as composable Spark jobs.

Sub-packages
    functions   column expressions (money, time)
    operators   DataFrame -> DataFrame building blocks
    sources     readers, sinks and the incremental table writer
    plans       the silver/gold tables and serving queries built from operators
    streaming   Structured Streaming jobs
    catalogue   the registered queries and their SQL counterparts
"""
