"""rangehaul: whole-table loading on Spark, by disjoint key ranges.

Profile a table, pick a split key, cut it into ranges, read the ranges in
parallel, conform types, write sized files, publish once, prove the copy.
"""

__version__ = "0.1.0"
