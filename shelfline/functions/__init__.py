"""Column expressions. Nothing here triggers a job or needs Python on the executors."""
