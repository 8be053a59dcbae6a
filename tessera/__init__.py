"""tessera — the data jobs of a small Spark SQL job collection, rebuilt as
plain ``DataFrame -> DataFrame`` functions on PySpark.

Layout
------
``sources``    readers and writers (delimited text, Parquet, JSON, JDBC, catalog tables)
``functions``  column-expression builders (tokenising, JSON access, record formatting)
``operators``  the jobs themselves (filters, lookups, trails, itemsets, keywords,
               category encoding, linear SVM)
``plans``      plan-shaping helpers (checkpointing, dense indexing, size-checked joins)
``streaming``  Structured Streaming variants of the batch operators
``jobs``       the registered queries over the driver's test tables
"""

__all__ = ["operators", "sources", "functions", "plans", "streaming"]
