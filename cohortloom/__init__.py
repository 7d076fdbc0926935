"""cohortloom: cross-cohort harmonization as Spark DataFrame jobs."""
