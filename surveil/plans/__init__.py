"""Report jobs composed from the operators."""
