from .refresh import correct_sales, refresh_star
from .star import build_dims, build_facts, build_star, publish_star, read_star

__all__ = [
    "build_dims",
    "build_facts",
    "build_star",
    "correct_sales",
    "publish_star",
    "read_star",
    "refresh_star",
]
