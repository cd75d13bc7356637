"""Operators for preparing training text. Nothing else in the library imports this package.

minhash      near-duplicate documents          tokencount  tokens per document from shared prefixes
decontaminate  benchmark passages in documents  quality    document rules and line frequency per host
substring    repeated passages                 lines       near-equal lines
warc         web archives and their index      secrets     credentials with false positives removed
archive      token ids in seekable files       packing     sequences of a fixed length
"""
