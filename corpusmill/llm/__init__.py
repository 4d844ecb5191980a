"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage. ``catalog`` holds its
registered queries, ``oracle`` the SQL of those that SQL can express.
"""
