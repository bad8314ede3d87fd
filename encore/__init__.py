"""Event leaderboards and engagement analytics on Spark."""
