"""Daily count series on Spark: cleaning, features, forecasts and their quality."""
