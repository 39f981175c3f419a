"""``python -m kinlink JOB [--config FILE] [--root URI] [--namespace NAME]`` (or the same under ``spark-submit``)."""

from __future__ import annotations

import argparse

from kinlink.config import add_arguments, config_from_arguments
from kinlink.plans.jobs import JOBS
from kinlink.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="kinlink")
    parser.add_argument("job", choices=sorted(JOBS))
    add_arguments(parser)
    args = parser.parse_args()
    report = JOBS[args.job](build_session(f"kinlink-{args.job}"), config_from_arguments(args))
    if report is not None:
        print(report)


if __name__ == "__main__":
    main()
