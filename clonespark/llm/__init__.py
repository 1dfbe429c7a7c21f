"""Training-data operators: text quality, language, extraction, dedup, tokens, search.

Nothing else in the library imports this subpackage; removing it leaves the
repertoire operators intact.
"""
