"""tamis: a document screening and corpus curation engine on Spark DataFrames."""
