"""Training-data operators: filters, deduplication, mixing, packing and output of text corpora."""
