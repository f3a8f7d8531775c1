"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import abuse, addresses, entities, mixing, names, sampling, tokens
from weftlink.llm.sql import ORACLES
from weftlink.session import cut, table


def _sample(spark: SparkSession, sf_dir: str) -> sampling.Sample:
    return sampling.sample_to_targets(table(spark, sf_dir, "labeled_cases"), table(spark, sf_dir, "sample_targets"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that the supply can't meet."""
    return _sample(spark, sf_dir).report.where("short").select("request_id", "category").distinct()


def p1_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn cases of every request."""
    return _sample(spark, sf_dir).rows.select("request_id", "case_id", F.array_join("cell", "|").alias("cell"))


def p1_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct cases of every request that draws any: as many as it asks for, or all there are."""
    return _sample(spark, sf_dir).rows.groupBy("request_id").agg(F.count("*").alias("n_rows"), F.countDistinct("case_id").alias("n_cases"))


def p1_minimums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawn rows of every category, counted up to its minimum: all of the minimum, as far as the supply goes."""
    s = _sample(spark, sf_dir)
    cases = table(spark, sf_dir, "labeled_cases").where("case_id is not null").dropDuplicates(["case_id"])
    goals = table(spark, sf_dir, "sample_targets")
    keys = [r[0] for r in goals.select("strata_key").distinct().sort("strata_key").collect()]
    said = cases.select("case_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*[sampling.category(F.lit(k), F.col("strata"), F.col("rationale")) for k in keys]))).alias("strata_key", "category"))
    drawn = s.rows.join(said, "case_id").groupBy("request_id", "strata_key", "category").agg(F.count("*").alias("n"))
    return goals.join(drawn, ["request_id", "strata_key", "category"], "left").select("request_id", "strata_key", "category", F.least("min_rows", F.coalesce("n", F.lit(0))).alias("n_of_minimum"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supply, target, draws and gap of every request and category."""
    return _sample(spark, sf_dir).report


def _entities(spark: SparkSession, sf_dir: str) -> entities.Matches:
    return entities.match_entities(table(spark, sf_dir, "outside_records"), table(spark, sf_dir, "internal_records"), "outside_id", "internal_id", "source", "target")


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir).pairs.select(F.col("left").alias("outside_id"), F.col("right").alias("internal_id"), "confidence")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outside and internal records of the same person."""
    return _matches(spark, sf_dir).where(F.col("confidence") >= entities.SAME).select("outside_id", "internal_id")


def p2_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair with its confidence."""
    return _matches(spark, sf_dir)


def p2_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How confidences of labelled candidates that the model did not see compare with the share of true pairs, in tenths."""
    return spark.createDataFrame(_entities(spark, sf_dir).reliability, "bin long, n long, confidence double, share double")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of address records that denote the same location."""
    return addresses.expand(addresses.match_addresses(table(spark, sf_dir, "person_addresses")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of typed names that name the same person."""
    return names.expand(names.link_names(table(spark, sf_dir, "typed_names")))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_corpus(table(spark, sf_dir, "documents"))


def _mix(spark: SparkSession, sf_dir: str) -> mixing.Mix:
    docs = cut(tokens.count_tokens(table(spark, sf_dir, "documents"), keep=("source",)))
    return mixing.mix(docs, table(spark, sf_dir, "mix_targets"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that can't reach their share."""
    return _mix(spark, sf_dir).report.where("short").select("recipe_id", "source").distinct()


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of a document in a mix, with its slot."""
    return _mix(spark, sf_dir).rows


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares."""
    return _mix(spark, sf_dir).report


def _scores(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return abuse.score_documents(docs, abuse.fit_labels(docs, table(spark, sf_dir, "content_labels")), keep)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with abusive, hateful or sexual language."""
    return _scores(spark, sf_dir).where("flagged").select("doc_id").distinct()


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    return _scores(spark, sf_dir)


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the share of abusive ones per source."""
    scored = _scores(spark, sf_dir, "source").withColumn("source", mixing.canonical_source(F.col("source")))
    return scored.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if("flagged").alias("n_flagged"), F.avg(F.col("flagged").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))


QUERIES = {f.__name__: f for f in (p1_found, p1_sample, p1_sizes, p1_minimums, p1_report, p2_found, p2_confidence, p2_reliability, p4_found, p5_found, p6_ids, p7_found, p7_mix, p7_report, p8_found, p8_scores, p8_rates)}
