"""Operators of a training-data pipeline (documents, embeddings, pages, chats).

Nothing outside this folder imports it; ``queries`` holds the registered queries.
"""
