"""Operators for preparing training data at corpus scale.

Every module is one operator: a DataFrame in, a DataFrame out, with the work
spread by Spark's partitions and shuffles.  Nothing else in the library imports
this package.
"""
