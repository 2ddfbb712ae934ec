"""Crawl analytics and web-archive operations as Spark DataFrame plans."""

__version__ = "0.1.0"
