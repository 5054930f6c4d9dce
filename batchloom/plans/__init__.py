"""Table loads and the batch run built from the operators."""
