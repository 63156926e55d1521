"""The analytical products, composed from the operators."""
