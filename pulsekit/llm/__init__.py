"""Operators for building training corpora: one module per operator.

Nothing outside this folder imports it; ``queries.py`` holds what
``__spark_entry__.py`` registers.
"""
