"""Column functions: day and hour keys, vectors, one-hot codes, JSON sequences."""
