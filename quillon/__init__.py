"""quillon: a DataFrame-native analytics engine for multi-factor equity risk models."""

__version__ = "0.1.0"
