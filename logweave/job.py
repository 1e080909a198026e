"""Command-line jobs (S12), the same under ``spark-submit``.

* ``python -m logweave.job <train> <result> <test>``: rule labels (J1). Reads
  ``messages_testset.txt`` and ``sysmonitor_testset.txt`` from the test folder, writes
  ``predict.csv`` and then the ``predict_finish.csv`` marker to the result folder. The train
  folder is accepted and not read (as in the reference).
* ``python -m logweave.job detect <train> <result> <test> [fit_id]``: template mining and both
  detectors (M3, M6), see ``plans/detection.py``.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from logweave.plans.detection import run_detection
from logweave.plans.labelling import run_label_job
from logweave.session import apply_defaults, ensure_checkpoint_dir

USAGE = """usage: python -m logweave.job <train_path> <result_path> <test_path>
       python -m logweave.job detect <train_path> <result_path> <test_path> [fit_id]"""


def main(argv: list[str]) -> int:
    detect = argv[:1] == ["detect"]
    paths = argv[1:] if detect else argv
    if not 3 <= len(paths) <= 3 + detect:
        print(USAGE, file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("logweave-job").getOrCreate()
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    train_path, result_path, test_path = paths[:3]
    if detect:
        run_detection(spark, train_path, result_path, test_path, *paths[3:])
    else:
        run_label_job(spark, test_path, result_path, train_path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
