"""Column-level vocabulary: every function takes and returns Columns."""
