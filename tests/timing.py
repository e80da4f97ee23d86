"""Seconds per registered query, planning apart from running."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vocabweave.plans.all_queries import QUERIES  # noqa: E402
from vocabweave.session import local_session  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1]
    spark = local_session("8")
    QUERIES["null_like"](spark, folder).count()
    for name in sys.argv[2:] or list(QUERIES):
        start = time.time()
        frame = QUERIES[name](spark, folder)
        built = time.time()
        frame.write.format("noop").mode("overwrite").save()
        print(f"{name:28s} build {built - start:6.1f}  run {time.time() - built:6.1f}", flush=True)
