"""Whole recipes as one call each; lazy up to the writer."""
