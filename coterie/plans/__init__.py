"""How the operators are laid out on a cluster: saved steps, skew-safe joins, ranks."""
