"""Training-data operators: packing, near-duplicate search, classifiers, scans and token counts.

Nothing else in the library imports this subpackage; its queries are registered in ``queries.py``.
"""
