"""Spark-native operators for phased, longitudinal studies.

Every public function takes DataFrames and plain parameters and returns a lazy
DataFrame (or a Column); nothing is computed until the caller runs an action.
"""
