"""Run one job: ``python -m tastemap JOB --help``, or the same through spark-submit."""

import argparse

from pyspark.sql import Observation, SparkSession

from tastemap.operators.filters import filter_points
from tastemap.operators.points import map_points
from tastemap.operators.ranking import take_rows
from tastemap.operators.sampling import take_exact_fraction, take_fraction
from tastemap.operators.sentiment import VOCABULARY_SIZE, load_model, save_model
from tastemap.operators.stats import STATS
from tastemap.plans import jobs
from tastemap.sources.durable import intermediates
from tastemap.sources.export import export_page, export_points
from tastemap.sources.schemas import (BUSINESS, JOINED_SENTIMENT, REVIEW, REVIEW_SENTIMENT,
                                      check_columns)
from tastemap.sources.tables import check_target, read_table, spread, write_table
from tastemap.sources.versions import is_versioned, publish, read_version, resolve

# Per job: its input tables, and the columns it reads of each.
INPUTS = {
    "rating-by-state": {"business": ("state", "stars")},
    "rating-by-cuisine": {"business": ("categories", "stars")},
    "sentiment-by-state": {"joined": ("state", "predicted_sentiment")},
    "sentiment-by-cuisine": {"joined": ("categories", "predicted_sentiment")},
    "business-sentiment": {"sentiment": ("business_id", "predicted_sentiment"),
                           "business": ("business_id",)},
    "train": {"reviews": ("review_id", "text", "stars")},
    "score": {"reviews": ("review_id", "business_id", "text", "stars")},
    "export-points": {"joined": ("business_id", "name", "address", "city", "state",
                                 "postal_code", "stars", "predicted_sentiment", "longitude",
                                 "latitude")},
}
SCHEMAS = {"business": BUSINESS, "reviews": REVIEW, "sentiment": REVIEW_SENTIMENT,
           "joined": JOINED_SENTIMENT}
# Jobs that can run on a fraction of their rows, with the key that identifies a row.
FRACTION_KEYS = {"rating-by-state": "business_id", "sentiment-by-state": "business_id",
                 "score": "review_id"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tastemap")
    commands = top.add_subparsers(dest="job", required=True)
    for job, inputs in INPUTS.items():
        command = commands.add_parser(job)
        for table in inputs:
            command.add_argument(f"--{table}", required=True, help="table to read")
        if job in ("train", "score"):
            command.add_argument("--model", required=True, help="model directory")
        if job != "train":
            command.add_argument("--out", required=True, help="table or folder to replace")
        if job == "rating-by-cuisine":
            command.add_argument("--stats", nargs="+", default=["avg"], metavar="NAME",
                                 choices=[*STATS, "median"], help="statistics, avg by default")
        if job != "export-points":
            command.add_argument("--versioned", action="store_true",
                                 help="keep the old target readable until the new one is whole; "
                                      "a target that has versions always gets one more")
            command.add_argument("--keep", type=int, metavar="N",
                                 help="of a versioned target, remove all but the newest N versions")
        if job in ("train", "score"):
            command.add_argument("--partitions", type=int,
                                 help="deal the reviews out over so many partitions first")
        if job not in ("train", "export-points"):
            command.add_argument("--show", action="store_true", help="print some of the result")
        command.add_argument("--format", default="parquet")
        command.add_argument("--target-option", default="path",
                             help="option by which the format names a table")
        command.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                             help="further option of the format")
        if job in FRACTION_KEYS:
            command.add_argument("--fraction", metavar="NUM/DEN", help="part of the rows to use")
            command.add_argument("--exact", action="store_true",
                                 help="exactly that many rows, the lowest keys")
        if job.startswith("sentiment-by"):
            command.add_argument("--weighted", action="store_true",
                                 help="weight businesses by their reviews")
        if job == "train":
            command.add_argument("--features", choices=("tfidf", "count"), default="tfidf")
            command.add_argument("--num-features", type=int, default=20)
            command.add_argument("--vocabulary-size", type=int, default=VOCABULARY_SIZE,
                                 help="commonest terms that count features keep")
            command.add_argument("--max-iter", type=int, default=50)
            command.add_argument("--reg-param", type=float, default=0.3)
            command.add_argument("--seed", type=int, help="seed of the split into train and test")
            command.add_argument("--fit-partitions", type=int,
                                 help="partitions of the term counts in each round")
            command.add_argument("--rows", type=int, help="use the first rows by review_id only")
        if job == "export-points":
            command.add_argument("--rows", type=int, default=1000)
            command.add_argument("--single-file", action="store_true",
                                 help="one JSON array in a file of that name, not a folder of lines")
            command.add_argument("--raw", action="store_true",
                                 help="the joined rows, for a page that places them itself")
            command.add_argument("--postal-code")
            command.add_argument("--category", help="text that the categories contain")
            command.add_argument("--price", action="append", help="price point, repeatable")
            command.add_argument("--price-range", nargs=2, type=float, metavar=("LOW", "HIGH"))
            command.add_argument("--price-column", default="price")
            command.add_argument("--colour-by", help="column, the rating by default")
            command.add_argument("--colour-kind", choices=("number", "price", "category"),
                                 default="number")
            command.add_argument("--colour-best", type=float, default=5.0,
                                 help="greenest value of that column, or number of dollar signs")
            command.add_argument("--colour-category", action="append", default=[],
                                 help="category from red to green, repeatable")
    return top


def run(spark: SparkSession, argv=None) -> None:
    """Run one job; what it writes in between is removed at its end."""
    args = parser().parse_args(argv)
    sources = [getattr(args, t) for t in INPUTS[args.job]]
    if args.job == "score":
        sources.append(args.model)
    if getattr(args, "versioned", False) and args.target_option != "path":
        raise ValueError("only a target named by path can have versions")
    # Before any work: a target that would destroy what the job reads.
    if args.job == "train":
        check_target(spark, args.model, sources)
    elif args.target_option == "path" or args.job == "export-points":
        check_target(spark, args.out, sources)
    with intermediates(spark):
        _run(spark, args, sources)


def _run(spark: SparkSession, args: argparse.Namespace, sources: list[str]) -> None:
    options = dict(o.split("=", 1) for o in args.option)
    tables = {}
    for table, columns in INPUTS[args.job].items():
        # A job that keeps all columns of a JSON table infers them; the others get
        # their schema, so that no pass infers it.
        whole = args.job == "business-sentiment" and table == "business" or (
            args.job == "export-points")
        schema = SCHEMAS[table] if args.format == "json" and not whole else None
        place = getattr(args, table)
        if args.target_option == "path":
            place = resolve(spark, place)
        df = read_table(spark, place, args.format, schema, args.target_option, **options)
        tables[table] = check_columns(df, SCHEMAS[table], columns)
    if getattr(args, "fraction", None):
        num, den = map(int, args.fraction.split("/"))
        cut = take_exact_fraction if args.exact else take_fraction
        tables = {t: cut(df, FRACTION_KEYS[args.job], num, den) for t, df in tables.items()}

    if args.job == "train":
        grade = jobs.train if args.features == "tfidf" else jobs.train_count_features
        extra = {"max_iter": args.max_iter, "reg_param": args.reg_param,
                 "partitions": args.fit_partitions}
        if args.seed is not None:
            extra["seed"] = args.seed
        if args.features == "tfidf":
            extra["num_features"] = args.num_features
        else:
            extra |= {"vocabulary_size": args.vocabulary_size, "on_terms": lambda total, out: print(
                f"terms: {total}, left out of the vocabulary: {out}")}
        reviews = tables["reviews"]
        if args.rows is not None:
            reviews = take_rows(reviews, "review_id", args.rows)
        left_out = Observation("left out")
        trained = grade(spread(reviews, args.partitions), observation=left_out, **extra)
        save_model(trained.model, args.model, sources, args.versioned, args.keep)
        trained.quality.show()
        print("left out:", left_out.get)
        return
    if args.job == "export-points":
        joined = filter_points(tables["joined"], args.price, args.price_range, args.postal_code,
                               args.category, price_col=args.price_column)
        points = joined if args.raw else map_points(
            joined, keep=("business_id",), colour_by=args.colour_by, colour_best=args.colour_best,
            colour_kind=args.colour_kind, colour_categories=args.colour_category)
        export = export_page if args.single_file else export_points
        export(points, args.out, "business_id", args.rows, sources)
        return
    if args.job == "score":
        result = jobs.score(load_model(args.model), spread(tables["reviews"], args.partitions))
    elif args.job == "business-sentiment":
        result = jobs.business_sentiment(tables["sentiment"], tables["business"])
    elif args.job.startswith("sentiment-by"):
        by = jobs.sentiment_by_state if args.job.endswith("state") else jobs.sentiment_by_cuisine
        result = by(tables["joined"], weighted=args.weighted)
    elif args.job == "rating-by-state":
        result = jobs.rating_by_state(tables["business"])
    else:
        result = jobs.rating_by_cuisine(tables["business"], stats=args.stats)
    versioned = args.target_option == "path" and (args.versioned or is_versioned(spark, args.out))
    if versioned:
        publish(result, args.out, args.format, sources=sources, keep=args.keep, **options)
    else:
        write_table(result, args.out, args.format, target_option=args.target_option,
                    sources=sources, **options)
    if args.show:
        written = read_version(spark, args.out, **options) if versioned else read_table(
            spark, args.out, args.format, None, args.target_option, **options)
        written.printSchema()
        written.show(truncate=False)


def main() -> None:
    spark = SparkSession.builder.appName("tastemap").getOrCreate()
    try:
        run(spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
