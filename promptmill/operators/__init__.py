"""DataFrame operators; all lazy, all usable with ``df.transform``."""
