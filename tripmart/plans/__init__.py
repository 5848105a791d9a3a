"""Compositions: monthly ELT, back-fill, monthly models, full month."""
