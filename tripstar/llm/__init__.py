"""Training-data operators.

One module per operator (``op1`` .. ``op10`` in :mod:`tripstar.llm.registry`).
Nothing else in the library imports this subpackage.
"""
