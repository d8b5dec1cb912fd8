"""The jobs of each layer, built from the operators."""
