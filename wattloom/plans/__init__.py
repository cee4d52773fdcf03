"""The energy domain: multiplier catalogues and the staged workflow."""
