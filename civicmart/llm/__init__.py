"""Operators for preparing training text at scale.

Nothing else in the library imports this package. Each module holds one operator with a
general interface; ``queries.py`` binds them to the standard tables.
"""
