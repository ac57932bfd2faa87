"""Reading landed files and lookups, reading and writing tables."""
