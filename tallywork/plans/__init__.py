"""The survey's layers as functions from DataFrame to DataFrame, and the run over all of them."""
