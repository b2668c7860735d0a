"""Call and lead analytics as Spark jobs: DataFrames in, DataFrames out."""
