"""Training-data preparation operators.

A separate subpackage: nothing else in the library imports it, and it can be removed as a whole.
Each module holds one operator with its own general interface; `registry` has the thin queries.
"""
