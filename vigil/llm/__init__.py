"""Operators of a training-data pipeline: tokenising, mixing, near-duplicate
search, language and licence identification, quality rules, extraction and
scoring. Nothing outside this subpackage imports it."""
