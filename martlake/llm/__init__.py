"""Training-data operators: mixing, tokenisation, PII, dedup, WARC, URL and quality filters, vector search.

Nothing else in the library imports this subpackage.
"""
