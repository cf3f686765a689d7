"""pairloom: Spark jobs over corpora of ``(lang, raw, clean)`` text pairs."""
