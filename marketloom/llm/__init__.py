"""Operators for preparing training text: near-duplicates, licences, language, secrets, tokens,
benchmark leaks, source mixing, nearest neighbours, quality and language-model scores.

Nothing outside this subpackage imports it.  ``queries.py`` holds the registered queries.
"""
