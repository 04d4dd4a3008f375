"""leakwatch: Spark-native risk analytics for cloud file-upload events.

Composable DataFrame operators: rule features over file names, destinations,
time and roles; rolling per-user behaviour windows; incremental ingest and
scoring by key; Spark ML gradient-boosted trees with per-event explanations;
ranking, threshold and confusion metrics as distributed aggregates.
"""

__version__ = "0.1.0"
