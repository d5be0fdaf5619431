"""Set-based rules, checks and key maintenance over DataFrames."""
