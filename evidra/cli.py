"""Command line: ``python -m evidra.cli process|validate|compare ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import reporting as R
from .operators import scorers as M
from .operators import selection as S
from .operators import store
from .plans import extraction
from .sources import files


def process(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Claims of episodes (episode_id, podcast_id, air_date, text) that have none yet, saved as a new version; their results."""
    episodes = store.with_transcripts(spark.read.parquet(args.episodes), ["text"], "podcast_id", args.podcast or None)
    if args.latest:
        episodes = S.latest(episodes, "podcast_id", "air_date", "episode_id", args.latest)
    if args.episode:
        episodes = episodes.where(F.col("episode_id") == args.episode)
    if args.claims and not args.force:
        episodes = S.unprocessed(episodes, spark.read.parquet(args.claims), "episode_id")

    def step(good: DataFrame) -> DataFrame:
        return extraction.short(good, args.kind) if args.short else extraction.full(good, args.kind)["claims"]

    made, results = R.run_batch(episodes.select("episode_id", "text"), step, "episode_id", continue_on_error=not args.stop)
    if not args.dry_run:
        store.commit({"claims": made, "results": results}, args.out)
    return results.groupBy("status", "reason").agg(F.count("*").alias("n"))


def validate(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Flags claims (episode_id, claim_id, claim, is_flagged, is_verified) of episodes with enough unverified ones; what changed."""
    claims = spark.read.parquet(args.claims)
    chosen = S.eligible(claims.where(~F.col("is_verified")), "episode_id", args.least).select("episode_id")
    open_claims = claims.where(~F.col("is_verified")).join(chosen, "episode_id", "left_semi")
    answers = M.once(open_claims.select("claim_id", "claim"), ["claim"], lambda df: M.validate(df)).select("claim_id", "is_valid")
    if args.dry_run:
        return store.would_change(claims, answers.where(~F.col("is_valid")), "claim_id", ~F.col("is_flagged"))
    done = S.validated(open_claims, answers, "claim_id")
    store.commit({"claims": claims.join(open_claims.select("claim_id"), "claim_id", "left_anti").unionByName(done)}, args.out)
    return done.groupBy("is_flagged").agg(F.count("*").alias("n"))


def compare(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The leaderboard of training results."""
    return files.leaderboard(files.results(spark, *args.results), args.since, args.most)


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="evidra")
    kinds = made.add_subparsers(required=True)
    one = kinds.add_parser("process")
    one.set_defaults(run=process)
    one.add_argument("episodes")
    one.add_argument("out")
    one.add_argument("--claims")
    one.add_argument("--podcast", type=int, action="append")
    one.add_argument("--episode", type=int)
    one.add_argument("--latest", type=int)
    one.add_argument("--kind", default="numbered")
    for flag in ("--force", "--short", "--stop", "--dry-run"):
        one.add_argument(flag, action="store_true")
    two = kinds.add_parser("validate")
    two.set_defaults(run=validate)
    two.add_argument("claims")
    two.add_argument("out")
    two.add_argument("--least", type=int, default=5)
    two.add_argument("--dry-run", action="store_true")
    three = kinds.add_parser("compare")
    three.set_defaults(run=compare)
    three.add_argument("results", nargs="+")
    three.add_argument("--since")
    three.add_argument("--most", type=int, default=20)
    return made


def main(argv: list[str] | None = None) -> DataFrame:
    args = parser().parse_args(argv)
    out = args.run(SparkSession.builder.getOrCreate(), args)
    out.show(truncate=False)
    return out


if __name__ == "__main__":
    main()
