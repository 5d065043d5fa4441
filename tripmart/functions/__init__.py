"""Column expressions shared by the operators. None of them is a UDF."""
