"""DataFrame operators of the three layers."""
