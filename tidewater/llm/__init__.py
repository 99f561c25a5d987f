"""Training-data operators: quality, language, duplicates, contamination, URLs, tokens.

Each module holds one operator with its own interface; ``queries`` registers the
contract queries. Nothing outside this package imports it.
"""
