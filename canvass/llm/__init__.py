"""Operators for preparing training text: language identification, chat
formatting, document fingerprints, tokenisation, personal data, quality,
decontamination, near duplicates, token counts and sharding.

Nothing outside this subpackage imports it. ``catalog`` lists its queries.
"""
