"""Whole analyses and multi-step flows made from the operators."""
