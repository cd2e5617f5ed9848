"""Page-view analytics and churn data sets on Spark."""
