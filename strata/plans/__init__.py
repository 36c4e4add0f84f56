"""The jobs: silver, gold, dashboard datasets, bike rides, incremental, audits."""
