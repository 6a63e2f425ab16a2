"""Operators for building training data out of a document corpus.

Every operator is a function on DataFrames (any table with the named columns works); the module
``queries`` applies each one to the driver's tables.  Nothing else in the library imports this
subpackage.
"""
