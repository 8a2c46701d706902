"""Driver-side plans: training, scoring, retraining and the monitoring cycle.

They start Spark jobs and hold only metrics, names and versions on the driver.
"""
