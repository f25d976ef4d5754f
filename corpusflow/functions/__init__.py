"""Column functions: they add no shuffle and run inside the caller's stage."""
