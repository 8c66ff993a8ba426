"""Results and standings analytics as Spark jobs.

Every public function takes DataFrames or Columns and returns a DataFrame or a
Column.  Nothing is collected; the only eager steps are writes of staged tables.
"""
