"""Operators of a training-data pipeline over document tables.

Each module holds one operator with a general ``DataFrame -> DataFrame``
interface; ``queries`` registers one query per operator on the ``documents``
table.  Nothing else in the library imports this subpackage.
"""
