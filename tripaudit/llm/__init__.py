"""Operators for preparing large training corpora as Spark jobs.

One module per operator; ``queries`` registers one query per operator over the
given tables.  Nothing outside this subpackage imports it.
"""
