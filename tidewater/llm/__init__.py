"""Training-data operators: sharding, byte-level BPE, decontamination, secret
scans, fingerprints, quality scoring, token-id files, substring dedup, n-gram
joins and WARC archives. Nothing outside this folder imports it, except the
guarded registration and ``corpus_pipeline``."""
