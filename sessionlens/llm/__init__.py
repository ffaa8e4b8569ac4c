"""Training-data operators over document, benchmark, page and label tables.

One module per operator; ``queries`` holds the registered ``opN_*`` queries.
Nothing outside this folder imports it.
"""
