"""Column functions and window helpers."""
