"""Operators for preparing training text, and the queries registered for them.

Nothing else in the library imports this package.
"""
