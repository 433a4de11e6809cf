"""corpusgrams: corpus statistics and n-gram language models on Spark."""
