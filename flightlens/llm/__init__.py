"""Training-data operators: dedup, packing, mixing, labels and scans over a table of documents."""
