"""Operators for preparing language-model training data at scale.

Nothing outside this package imports it. Each module holds one operator with a general interface;
`queries` applies the operators to the given tables under their production parameters.
"""
