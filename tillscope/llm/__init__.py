"""Operators for preparing training text at cluster scale.

Each module holds one operator with a general interface over DataFrames;
``queries`` binds them to the driver's tables and ``corpus_pipeline`` (at the
repository top) chains five of them.  Nothing outside this package imports it.
"""
