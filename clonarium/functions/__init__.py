"""Column expressions: identifiers, clones, loci, labels."""
