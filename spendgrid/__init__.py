"""spendgrid: retail transaction analytics as DataFrame-to-DataFrame functions."""

from spendgrid.params import Params

__all__ = ["Params"]
