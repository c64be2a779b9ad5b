"""quern: corpus curation and lexicon analytics as Spark DataFrame operators."""
