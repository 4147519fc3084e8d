"""Column functions: no I/O, no shuffles, usable in batch and in streams."""
