"""Operators of a training-data pipeline: one module per operator, their
queries in ``queries`` and the SQL for them in ``oracle``.  Nothing else in the
library imports this subpackage."""
