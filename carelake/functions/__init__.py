"""carelake subpackage."""
