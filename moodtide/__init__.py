"""Chat-sentiment scoring, hopping-window averages and alerts as Spark DataFrame operators."""
