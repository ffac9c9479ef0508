"""Operators of a training-data pipeline: packing, deduplication, archives, scoring, tokenizing.

Nothing else in the library imports this subpackage.  Each module holds one operator with its
own general interface; ``queries`` registers one thin query per operator.
"""
