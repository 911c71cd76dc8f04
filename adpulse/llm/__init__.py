"""Operators for preparing training data: nothing outside this subpackage imports them.

Each module holds one operator with its general interface; `catalog.py` registers
one `opN_<name>` query per operator, `oracle.py` the DuckDB statements of those
that SQL can express.
"""
