"""Column functions: declared types, casts, epoch conversions."""
