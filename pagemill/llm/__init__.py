"""Training-data operators: packing, dedup, secret scans, search, chat formatting, sharding, mixing, quality, URL filters."""
