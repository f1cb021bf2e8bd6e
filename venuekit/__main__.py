"""``python -m venuekit --business B --reviews R --checkins C --out O``: run every job."""

import argparse

from venuekit import schema as S
from venuekit.plans.run import STAGES, run_all
from venuekit.session import get_session

CHECKIN_SHAPES = {"list": S.CHECKIN_LIST, "map": S.CHECKIN_MAP, "pairs": S.CHECKIN_PAIRS}

parser = argparse.ArgumentParser(prog="venuekit", description="Venue analytics from JSON lines.")
parser.add_argument("--business", required=True)
parser.add_argument("--reviews", required=True)
parser.add_argument("--checkins", required=True)
parser.add_argument("--out", required=True)
parser.add_argument("--nested", action="store_true", help="place fields are nested, categories are an array")
parser.add_argument("--checkin-shape", choices=sorted(CHECKIN_SHAPES), default="list")
parser.add_argument("--no-models", action="store_true")
parser.add_argument("--stages", nargs="+", choices=STAGES, default=STAGES, help="run only these; others are read from --out")
args = parser.parse_args()

spark = get_session()
run = run_all(
    spark, args.business, args.reviews, args.checkins, args.out,
    S.BUSINESS_NESTED if args.nested else S.BUSINESS, CHECKIN_SHAPES[args.checkin_shape], not args.no_models,
    args.stages,
)
if "load" in args.stages:
    spark.read.parquet(run.path("reports/corrupt_records")).show()
