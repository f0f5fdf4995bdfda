"""Column functions: genotypes, lengths, types, sequences."""
