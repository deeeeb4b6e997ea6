"""Column expressions: collation, numbers, codes, specs, texts and addresses."""
