"""The asset DAG, the pipeline runs (staging job, medallion run, monthly job) and quality checks."""
