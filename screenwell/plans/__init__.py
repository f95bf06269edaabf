"""End-to-end jobs built from operators."""
