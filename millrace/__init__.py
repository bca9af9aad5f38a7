"""millrace: data integration and quality operators for Spark DataFrames.

Sources, streaming ingestion, operators and whole plans live in their own packages; see the README for
the list of functions.
"""

from __future__ import annotations

__version__ = "0.1.0"
