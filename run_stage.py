"""Launcher for ``spark-submit``: ``spark-submit run_stage.py <stage> ...`` (see rrspark/cli.py)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rrspark.cli import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
