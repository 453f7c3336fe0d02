"""Column expressions: text normalisation, similarity arithmetic, genre tags, labels."""
