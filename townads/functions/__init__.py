"""Column functions. Each takes and returns Columns, so batch and streaming plans share them."""
