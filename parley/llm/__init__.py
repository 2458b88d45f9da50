"""Training-data operators: search, deduplication, filtering, mixing and tokenizing of a text corpus."""
