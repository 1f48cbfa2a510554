from .products import stream_products

__all__ = ["stream_products"]
