"""Operators on texts for training corpora: packing, mixing and spam pages. Nothing else in the package imports this."""
