"""The recommender's operators; each takes and returns DataFrames."""
