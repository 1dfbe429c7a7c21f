"""Tools outside of Spark: their commands, parsers of what they print, and native stand-ins for small cases."""
