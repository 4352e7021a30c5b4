"""Training-data operators: cleaning, deduplication, mixing, packing, token
counts, language-model scoring and licence scans over document tables.

One module per operator.  Nothing else in the library imports this subpackage;
``registry`` holds its queries and their SQL.
"""
