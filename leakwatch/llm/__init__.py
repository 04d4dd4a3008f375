"""Training-data operators: filters, deduplication, packing and formatting of text corpora.

Nothing else in the library imports this subpackage. Every operator is a
function from DataFrames to DataFrames; ``queries`` holds the registered
queries and their SQL twins.
"""
