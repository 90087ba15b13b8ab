"""Training-data pipeline operators.  Nothing outside this subpackage, the
guarded registration in ``__spark_entry__`` and ``corpus_pipeline`` imports it."""
