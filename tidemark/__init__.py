"""Loading and maintaining warehouse tables with Spark DataFrames."""
