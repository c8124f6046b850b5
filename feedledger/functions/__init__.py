"""Column expressions: everything here returns a ``Column`` (or a driver-side literal helper)."""
