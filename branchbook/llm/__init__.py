"""Training-data pipeline operators (URL filters, deduplication, search, quality,
packing, scans, language identification, tokenization).

Nothing else in the library imports this subpackage; ``registry`` lists its
queries and their SQL.
"""
