"""feedloom: content ranking and recommendation over click logs, as Spark jobs."""

__version__ = "0.1.0"
