"""Spark jobs that turn a normalised shop catalogue into nested search documents."""

from shelfweave.session import build_session

__all__ = ["build_session"]
