"""lexigrain: ranked-lexicon analytics as Spark DataFrame jobs."""
