"""DataFrame-in, DataFrame-out operators; they chain with ``df.transform``."""
