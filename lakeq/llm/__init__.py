"""Training-data operators (line dedup, HTML extraction, packing, search, mixing,
set-similarity join, quality and language models, embedding near-dedup, URL filter).

Nothing outside this subpackage imports it. ``queries.QUERIES`` and
``queries.ORACLE`` register the operators; ``corpus_pipeline.py`` at the
repository top chains five of them.
"""
