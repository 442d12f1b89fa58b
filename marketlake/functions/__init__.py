"""Column functions."""

from marketlake.functions import exact, geo, scalars, text

__all__ = ["exact", "geo", "scalars", "text"]
