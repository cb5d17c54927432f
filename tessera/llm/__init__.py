"""Operators for training-data pipelines.

Every module holds one operator as ``DataFrame -> DataFrame`` functions.
``queries`` registers them; nothing outside this package imports it except
the guarded hook in ``__spark_entry__``."""
