"""Training-data operators: cleaning, de-duplicating, decontaminating, scoring and tokenising a
corpus of documents. Nothing outside this subpackage imports it; ``queries.py`` registers the
``opN_*`` queries and ``corpus_pipeline.py`` at the repository top chains five of the operators."""
