"""Text-sentiment analytics over DataFrames: charts, mentions, tokens, models, daily metrics."""
