"""Clock and default parameters shared by operators and stats."""

FRAME_RATE = 30  # frames per second
FRAMES_PER_MINUTE = FRAME_RATE * 60

# Width (in frames) of the ordering buckets used by the two-phase window
# operators.  A bucket is the unit of work of one window task, so it bounds
# the rows any single task sorts even when one replay/unit is very hot.
DEFAULT_BUCKET_FRAMES = 18_000  # 10 minutes of game time

REPLAY_KEY = "replay_id"
