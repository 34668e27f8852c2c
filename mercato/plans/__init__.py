"""The jobs: retail queries, document jobs, exploration and reports."""
