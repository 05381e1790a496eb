"""Training-data operators (text corpora, vectors, urls).

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL.
"""
