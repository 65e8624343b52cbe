"""Listing analytics on Spark.

A library of ``DataFrame -> DataFrame`` functions for e-commerce search
listings: card extraction from archived result pages, first-seen
de-duplication (batch and streaming), data-quality profiling, a one-pass
cleaning projection, market questions and reporting marts.
"""

from bazaarlens.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
