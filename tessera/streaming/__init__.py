"""The cleaning plan over a stream."""
