"""siltloom: source trees, crawled pages and training records as DataFrames, from scan to clean dataset."""
