"""Column expressions: ids, keys, money, times and semi-structured values."""
