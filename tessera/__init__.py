"""tessera — Spark document-retrieval and record-analytics toolkit.

Operators are plain functions from DataFrames to DataFrames:

* ``tessera.functions``  column expressions (text rules, hashed embeddings, explode helpers)
* ``tessera.sources``    file sources (listing, whole-text documents, strict JSON sections)
* ``tessera.sinks``      the insert-only section store
* ``tessera.operators``  sections, retrieval, records, research corpus, messages, lookups,
                         validation, corrections and scrubbing
* ``tessera.streaming``  Structured Streaming forms
* ``tessera.plans``      the registered queries and their DuckDB oracle SQL

``tessera.session.build_session`` / ``configure`` set up a session.
"""

__version__ = "0.1.0"
