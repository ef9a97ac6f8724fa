"""Operators of a training-data pipeline (search, language, tokens, duplicates, packing,
extraction, scoring). Nothing outside this folder imports it; ``queries.py`` registers one
query per operator."""
