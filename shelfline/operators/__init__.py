"""DataFrame-to-DataFrame operators.

They are lazy, except those that store an intermediate table in the shared folder
(value counts, categories) so that a large input is read once.
"""
