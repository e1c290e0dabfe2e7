"""Command line: build snapshots and a submission from the original file layout.

    python -m footfall --data DIR [--weather DIR] --start 2017-03-12 --out DIR
"""

from __future__ import annotations

import argparse
from datetime import date


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="footfall")
    ap.add_argument("--data", required=True, help="folder with the input CSV files")
    ap.add_argument("--weather", default=None, help="folder with the prepared weather CSV")
    ap.add_argument("--start", default="2017-03-12", help="training start anchor (YYYY-MM-DD)")
    ap.add_argument("--out", required=True, help="output folder (snapshots/, submissions/)")
    ap.add_argument("--rounds", type=int, default=100, help="boosting rounds")
    args = ap.parse_args(argv)

    from footfall.operators.anchors import training_anchors
    from footfall.plans.forecast import run_forecast
    from footfall.session import get_session
    from footfall.sources.competition import competition_inputs

    spark = get_session()
    inputs = competition_inputs(spark, args.data, args.weather)
    train, test = training_anchors(date.fromisoformat(args.start))
    path, imp = run_forecast(spark, inputs, train, test, f"{args.out}/snapshots", f"{args.out}/submissions",
                             requested_ids=inputs.submission, max_iter=args.rounds)
    print(path)
    imp.show(20, truncate=False)


if __name__ == "__main__":
    main()
