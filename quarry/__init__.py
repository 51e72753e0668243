"""quarry: DataFrame operators for loading, cleaning, enriching, reporting,
modelling and streaming, expressed so that Catalyst plans all of the work."""

__version__ = "0.1.0"
