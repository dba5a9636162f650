"""Training-data operators: chat formatting, decontamination, WARC, HTML extraction,
fingerprints, quality, near-duplicate joins, sharding, mixing and language ID.

Nothing outside this package imports it.
"""
