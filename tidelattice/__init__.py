"""tidelattice: market and text feature engine on PySpark DataFrames."""
