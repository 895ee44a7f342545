"""Graph operators over plain DataFrames: edges are ``(src, dst)`` with ``src < dst``."""
