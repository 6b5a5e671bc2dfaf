"""People and company registry from scraped company pages, as Spark DataFrames."""
