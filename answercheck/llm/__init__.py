"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries`` registers a
thin ``opN_<name>`` query per operator. Nothing else in the library imports this
subpackage.
"""
