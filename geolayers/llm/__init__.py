"""Operators for preparing training data: text, tokens, languages, copies, vectors.

Nothing outside this folder imports it.
"""
