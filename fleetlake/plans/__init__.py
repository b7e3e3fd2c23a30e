"""The jobs of each layer, as functions from DataFrames to DataFrames."""
