"""listloom: extracts of list-based business systems as clean, joined Spark tables."""
