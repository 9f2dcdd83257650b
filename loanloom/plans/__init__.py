"""Composition of the operators: the derived bank, the query registry, the batch run."""
