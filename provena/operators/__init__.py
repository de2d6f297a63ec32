"""Transforms: DataFrame to DataFrame, lazy, without input or output of their own."""
