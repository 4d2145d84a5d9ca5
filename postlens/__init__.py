"""Analytics and classification of social-media posts on Spark DataFrames."""
