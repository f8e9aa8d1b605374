"""Layers and jobs composed of operators."""
