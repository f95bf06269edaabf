"""Chunking, keyword search, vector search, hybrid retrieval and cited answers."""
