"""tessera: preparing and analysing text and conversation corpora on Spark."""

__version__ = "0.1.0"
