"""Call-record analytics and churn modelling as Spark DataFrame jobs."""
