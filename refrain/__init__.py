"""refrain: subscription-churn analytics as Spark DataFrame jobs and MLlib pipelines."""
