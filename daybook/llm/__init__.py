"""Training-data operators: scoring, sanitising, deduplication, search, packing and formatting.

One module per operator. Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it; ``queries.py`` holds its registered queries.
"""
