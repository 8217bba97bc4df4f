"""skylane: flight-delay data preparation, modelling and evaluation as Spark plans."""

__version__ = "0.1.0"
