"""Operators of a training-data pipeline over the ``documents``, ``pages``, ``conversations`` and ``benchmark`` tables."""
