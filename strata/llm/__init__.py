"""Training-data operators: text, token and vector jobs over document tables.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``queries`` registers one query per operator.
"""
