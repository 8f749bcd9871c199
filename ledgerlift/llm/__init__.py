"""Training-data operators: deduplication, filtering, tokenization and packing of text corpora on Spark."""
