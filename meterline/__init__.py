"""Batch analytics and machine learning over trip-shaped tables on Spark.

Every operator takes and returns a ``DataFrame`` or a ``Column``. The caller owns
the session: nothing here sets a master, memory sizes or SQL options.
"""
