"""Training-data operators on Spark: toxicity, near-duplicates, substring dedup,
decontamination, tokenizing, URL rules, language, extraction, language models, quality.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
