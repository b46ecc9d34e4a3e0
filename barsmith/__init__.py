"""barsmith: daily equity-bar analytics on Spark DataFrames.

Layers: raw per-ticker bar tables -> staging (``sources``) -> returns, moving
averages and technical indicators (``operators``) -> the daily fact, the
per-ticker summary and the per-day portfolio view (``plans``).
"""

__version__ = "0.1.0"
