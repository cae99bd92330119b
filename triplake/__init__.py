"""Trip-record analytics on Spark: drifting monthly files and a message stream
in, one cleaned trip table, serving tables and a duration model out."""

__version__ = "0.1.0"
