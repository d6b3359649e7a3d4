"""Operators for preparing training text: language, duplicates, leaks, secrets, packing, scoring.

Nothing else in the library imports this package. Each operator has a module with a
general function and the registered query that applies it to a whole table.
"""
