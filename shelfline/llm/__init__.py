"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers the ``opN_<name>`` keys and
``ORACLE`` their DuckDB texts where SQL can express them.  Nothing outside
this package imports it (``__spark_entry__`` adds it when present).
"""
