"""Check operators over DataFrames."""
