"""cartwheel — clickstream analytics on Spark DataFrames.

Every operator is a DataFrame -> DataFrame function whose windows, thresholds
and dates are parameters, so the same code runs in Structured Streaming,
replay and batch (Kappa style).
"""

from cartwheel.config import StreamSettings

__all__ = ["StreamSettings"]
__version__ = "0.1.0"
