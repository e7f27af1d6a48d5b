"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage. Every operator reads only
the columns it names, so other columns, whatever they are called, do no harm;
each row is a document of its own, also where ids are null or repeated.
"""
