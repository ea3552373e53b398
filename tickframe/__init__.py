"""tickframe: frame-stamped telemetry analytics as Spark DataFrame jobs.

Every table carries ``replay_id``; every operator is partitioned by it (plus its
own keys), so a corpus of replays is processed in one distributed plan.
"""

__version__ = "0.1.0"
