"""DataFrame -> DataFrame operators: staging, engagement, benchmarks, scores, checks, reports."""
