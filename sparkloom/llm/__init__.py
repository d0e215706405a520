"""Operators of a large-scale training-data pipeline.

The subpackage stands alone: the rest of the library does not import it.
"""
