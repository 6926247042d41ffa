"""DataFrame operators: expectations, merges, history, allocation, matching, chunks, documents, search."""
