"""Trip-record analytics on Spark: monthly files, marts, demand forecast."""
