"""Training-data operators: search, dedup, quality, mixing, chat format, token files, WARC, BPE, source audit, token alignment.

Nothing outside this subpackage imports it.
"""
