"""Quality rules, transformation steps and analytics on DataFrames."""
