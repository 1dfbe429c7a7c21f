"""Operators from DataFrame to DataFrame. Each names the column that gives rows their order where that matters."""
