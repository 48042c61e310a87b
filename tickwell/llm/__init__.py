"""Training-data operators: cleaning, scoring, deduplication, search, mixing and packing of text corpora."""
