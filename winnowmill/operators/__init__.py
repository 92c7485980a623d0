"""DataFrame operators: everything here takes and returns a DataFrame."""
