"""Training-data operators: near and exact duplicates, search, tokens, secrets, personal data, filters."""
