"""Tidewell: a layered retail and log lake, expressed as PySpark DataFrames."""

from tidewell.session import build_session, configure, pin

__all__ = ["build_session", "configure", "pin"]
