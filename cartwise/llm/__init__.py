"""Training-data operators on documents, pages and embeddings.

Nothing outside this folder imports it, apart from the pipeline script at the
repository top and the guarded registration of queries.
"""
