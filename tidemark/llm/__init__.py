"""Operators for building training corpora, one module per operator, and their registered queries (``queries.py``)."""
