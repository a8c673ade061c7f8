"""Composite operators.  All take and return DataFrames; none collects rows to the driver except the
explicitly bounded query batch of the broadcast kNN path (rows and bytes checked by one ``take``)."""
