"""Column functions: text, estimates, classifiers, JSON, vectors, and the boundary to external models."""
