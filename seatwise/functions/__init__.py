"""Column expressions: all built in, nothing runs in Python workers."""
