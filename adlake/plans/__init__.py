"""Tables of each source: mappings from landed rows to typed, keyed tables."""
