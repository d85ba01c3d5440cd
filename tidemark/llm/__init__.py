"""Training-data operators: dedup, decontamination, language, tokens, PII, HTML, toxicity, chat.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only when it can be imported.
"""
