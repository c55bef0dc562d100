"""Corpus preparation operators: quality, URL lists, secrets, language, duplicates, tokens, contamination, toxicity."""
