"""tarazu: data processing for court records and text corpora on Spark DataFrames."""
