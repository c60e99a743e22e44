"""Training-data operators on Spark DataFrames: filtering, classification, near-duplicate joins, formatting,
tokenisation, scoring and mixing.  One module per operator; ``queries`` registers them."""
