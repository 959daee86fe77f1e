"""DataFrame operators. Row order is never implied: positional ones take ``order_by``."""
