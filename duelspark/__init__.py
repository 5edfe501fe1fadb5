"""duelspark: card-game client logs to normalized tables and metrics, on Spark."""
