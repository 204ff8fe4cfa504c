"""Column functions and series helpers shared by the operators."""
