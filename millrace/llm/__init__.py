"""Training-data operators: cleaning, deduplication, tokens, search and scoring of documents."""
