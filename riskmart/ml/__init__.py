"""Class-weighted binary classifiers on Spark ML."""
