"""Publisher index jobs on Spark: DataFrame operators over stories, blogs, feeds and posts."""
