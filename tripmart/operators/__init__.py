"""DataFrame operators: classification, duplicates, key lookup, checks."""
