"""Operators for training-data pipelines over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage; it may import general
helpers of the library. One module per operator; ``queries`` holds the thin
registered queries and ``oracles`` their SQL.
"""
