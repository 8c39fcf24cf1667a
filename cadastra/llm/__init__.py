"""Operators of a training-data pipeline over document tables. Nothing outside imports this."""
