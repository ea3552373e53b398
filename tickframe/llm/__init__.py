"""Operators for preparing language-model training data, as Spark jobs.

Nothing else in the library imports this subpackage.  ``registry.queries()``
and ``registry.oracle_sql()`` hold the driver's queries; every operator module
keeps its own general interface.
"""
