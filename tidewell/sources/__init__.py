"""sources of the library."""
