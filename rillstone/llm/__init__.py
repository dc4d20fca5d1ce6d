"""Operators for training text: packing, mixing and content scores. Nothing else in the library imports this."""
