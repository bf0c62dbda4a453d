"""quillspark: relation mining over text with Spark DataFrames."""
