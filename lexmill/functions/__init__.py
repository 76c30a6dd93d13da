"""Column helpers and small table helpers shared by the operators."""
