"""Business questions over the warehouse tables, each a function of DataFrames to a DataFrame."""
