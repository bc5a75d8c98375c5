"""Training-data operators (near-dedup, fixity audit, mixing, top-k, rollups, filters, token files)."""
