"""Feature stages, classifiers, tuning and batch scoring with Spark ML."""
