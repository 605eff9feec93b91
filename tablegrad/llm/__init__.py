"""Training-data operators: extraction, filtering, scoring, deduplication, packing and formatting of text corpora."""
