"""Composed flows over the operators: the mart chain and the scoring flow."""
