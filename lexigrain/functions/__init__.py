"""Column functions: native expressions, usable on any table."""
