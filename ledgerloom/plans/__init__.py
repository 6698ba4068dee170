"""The jobs: cleaning, staging, facts and dimensions, marts, measures, checks, monitoring, pipeline."""
