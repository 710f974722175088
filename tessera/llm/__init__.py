"""Operators for training-data pipelines over text corpora.

One module per operator; ``registry`` lists their queries and SQL.  Nothing
else in the library imports this package.
"""
