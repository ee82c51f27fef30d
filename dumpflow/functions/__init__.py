"""Column functions: identifiers, text, time and code lookups."""
