"""Column functions: text keys, mixes of named weights, vectors and signals."""
