"""Session-log feature engineering, evaluation and stateful scoring on Spark."""
