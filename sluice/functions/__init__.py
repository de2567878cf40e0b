"""Column expression builders: value maps, parsing, casts and digests."""
