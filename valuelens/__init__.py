"""Value of page views: variant samples and article boosts on Spark DataFrames."""
