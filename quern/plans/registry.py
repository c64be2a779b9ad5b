"""Registration of queries with the DuckDB statements they must equal."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

Q: dict = {}
SQL: dict[str, str] = {}
#: list columns of results; they come out as text, joined by SEP, so that any client compares them alike
LISTS = {
    "word_profiles": ["top_books"], "alignment_nest": ["words"], "version_differences": ["only_a", "only_b"], "word_families": ["related"], "meaning_variants": ["peers"],
    "sentence_scores": ["issues"], "token_grammar": ["found"], "provenance": ["sources", "senses"], "song_lines": ["first_lines"], "particle_references": ["refs"],
    "multi_sense_words": ["senses"], "translation_rules": ["failed"], "pattern_lookup": ["found"], "dictionary_terms": ["meanings"], "word_morphology": ["stems"],
    "headword_union": ["sources"], "burmese_union": ["sources"], "vocabulary_frequencies": ["sources"], "alignment_vocabulary": ["meanings", "examples", "collocations"], "syllable_export": ["syllables"],
    "chat_examples": ["messages"], "example_validation": ["issues"], "substring_search": ["match_in"], "quiz_questions": ["options"],
}
SEP = " | "


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, with its oracle if SQL can express it."""

    def add(f):
        name = f.__name__
        lists = LISTS.get(name, [])

        @wraps(f)
        def run(spark, d):
            df = f(spark, d)
            return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), SEP) for c in lists}) if lists else df

        Q[name] = run
        if sql:
            joined = ", ".join(f"array_to_string({c}, '{SEP}') AS {c}" for c in lists)
            SQL[name] = f"SELECT * REPLACE ({joined}) FROM ({sql})" if lists else sql
        return f

    return add
