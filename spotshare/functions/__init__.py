"""Column functions: days and months, labels, CSV text, text casts."""
