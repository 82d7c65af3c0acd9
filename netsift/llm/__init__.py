"""Operators for training-data pipelines over document, page and vector tables.

Nothing else in the library imports this subpackage.  Each module holds one operator with its own
interface; ``queries`` applies them to whole tables.
"""
