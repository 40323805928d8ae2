"""Operators for training-data preparation at corpus scale.

Each module holds one operator with a general DataFrame interface;
``registry.py`` applies them to the driver's tables as the ``opN_*`` queries.
Nothing else in the library imports this subpackage.
"""
