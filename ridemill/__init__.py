"""Trip-record analytics on Spark DataFrames.

Raw CSV batches or file streams become validated trip tables (current and
history), and those become three business tables: daily ridership, rolling
weekly route rankings and trip outliers.  Every operator takes and returns
DataFrames; see README.md for the map of modules.
"""
