"""Column-level building blocks: codecs, trims, casts, crypto, struct reshaping."""
