"""Operators for building language-model training data, and their queries.

Nothing else in the package imports this subpackage. Each module holds one
operator with a general interface; ``queries`` holds the thin ``opN_<name>``
queries over the driver tables. Operators never collect data that grows with
the input, never use ``localCheckpoint`` and write intermediate tables only to
the folder named by ``spark.checkpoint.dir``.
"""
