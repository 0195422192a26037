"""Operators for preparing training text: one module per operator.

Nothing else in the package imports this subpackage. ``queries`` holds the
registered queries and their SQL.
"""
