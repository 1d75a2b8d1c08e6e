"""Operators for preparing training text: one module per operator, queries in :mod:`tejado.llm.queries`.

Nothing else in the library imports this package; the package may import the library's helpers.
"""
