"""Operators of a training-data pipeline over the ``documents`` table.

One module per operator; ``queries`` registers them and ``checks`` holds their SQL.
Nothing outside this subpackage imports it.
"""
