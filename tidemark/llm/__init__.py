"""Operators of a large-scale training-data pipeline.

Thirteen operators, each in a module of its own, their registered queries
(``queries``) and the SQL that DuckDB runs for those that SQL can express
(``sql``).  Nothing else in the library imports this subpackage.
"""
