"""Column expressions: parsing, keys, clinical rules, masking."""
