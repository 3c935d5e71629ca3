"""Operators for preparing language-model training text.

Each ``opN_*`` module holds one operator with a general interface and a thin
registered query; ``registry`` lists the queries.  Nothing else in the library
imports this subpackage.
"""
