"""DataFrame-in, DataFrame-out quality operators."""
