"""Operators of a training-data pipeline over ``documents`` and ``conversations``.

Nothing outside this package imports it. Every operator reads only the
columns named in its arguments, so extra columns with any name do no harm.
"""
