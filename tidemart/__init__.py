"""Real-time e-commerce warehouse operators as ordinary Spark DataFrame functions."""

__version__ = "0.1.0"
