"""Column functions: every one takes and returns ``Column`` values."""
