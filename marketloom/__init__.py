"""Point-in-time market-data analytics on Spark.

``core`` holds schemas and conventions, ``sources`` reading, normalising, ingesting and writing, ``operators``
the lazy DataFrame transformations, ``functions`` column expressions, ``streaming`` the streaming jobs and
``plans`` the registered queries.
"""
