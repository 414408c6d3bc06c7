"""Risk-labelled record analytics on Spark DataFrames.

Layers, bottom up:

* ``functions``  column expressions (cleaning, text, numbers)
* ``operators``  DataFrame -> DataFrame steps (dedupe, flags, interval lookup, metrics ...)
* ``sources``, ``sinks``  the only modules that touch storage
* ``ml``         class-weighted classifiers and the run table
* ``plans``      the four end-to-end jobs: land, format, integrate, train
* ``workload``   the registered queries over the supplied tables and their SQL twins
"""
