"""Training-data operators: tokenising, filtering, deduplicating, sharding and packing text.

Nothing else in the library imports this subpackage.  Each operator module has a
general interface over any DataFrame; ``queries.py`` registers one query per
operator over the whole ``documents`` or ``embeddings`` table.
"""
