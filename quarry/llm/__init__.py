"""Training-data operators: each module is one operator on document, page or vector tables.

Nothing outside this subpackage imports it (the entry file and ``corpus_pipeline.py`` at the
repository top pick it up when it is present).
"""
