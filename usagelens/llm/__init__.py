"""Operations of a training-data pipeline over documents, vectors and web pages.

One module per operator; ``queries`` registers them. Nothing else in the library
imports this subpackage.
"""
