"""Operators for preparing training data, and their registered queries.

Nothing outside this folder imports it, except that ``__spark_entry__.py`` registers its queries when
it is there.
"""
