"""Column builders: complex numbers, flags, times and text keys."""
