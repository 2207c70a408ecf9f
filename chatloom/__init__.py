"""Chat analytics on Spark: raw chat to emote panel, titles, badge and user reports."""

__version__ = "0.1.0"
