"""Column → Column functions: number and text cleaning, dates, buckets."""
