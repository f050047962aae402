"""Training-data operators: dedup, media, mixing, scans, quality and tokenisation."""
