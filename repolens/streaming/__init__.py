"""Incremental processing of newly landed files.

The original runs a daily batch over a trailing window. The Spark-native
form of "process what landed since the last run" is a file stream with an
``availableNow`` trigger: each run picks up only new files (tracked in the
stream checkpoint, which survives executor and driver loss) and hands each
micro-batch to the same batch operators.
"""
