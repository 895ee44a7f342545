from .columns import both_directions, community_line, edge_key, score_line

__all__ = ["both_directions", "community_line", "edge_key", "score_line"]
