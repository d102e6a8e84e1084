"""Competing extraction branches: failure, agreement, scores and the choice of a primary one."""

from __future__ import annotations

import difflib
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfall.functions import text as T


def adjudicated(reports: DataFrame) -> DataFrame:
    """Per paper the source with most passes, the first seen on ties, and its passes as a share of all reports."""
    per = reports.groupBy("paper_id", "source").agg(F.count(F.when(F.col("status") == "pass", 1)).alias("passes"), F.count("*").alias("n"), F.min("report_id").alias("first_seen"))
    best = F.max(F.struct("passes", (-F.col("first_seen")).alias("o"), "source"))
    return per.groupBy("paper_id").agg(best["source"].alias("primary_source"), (best["passes"] / F.sum("n")).alias("confidence"))


def pairwise_agreement(reports: DataFrame) -> DataFrame:
    """For each two reports of a paper whether their statuses agree; pairs of branches, of which a paper has few."""
    r = reports.select("paper_id", "report_id", "source", F.coalesce("status", F.lit("none")).alias("status"))
    a, b = r.alias("a"), r.alias("b")
    pairs = a.join(b, (F.col("a.paper_id") == F.col("b.paper_id")) & (F.col("a.report_id") < F.col("b.report_id")))
    return pairs.select(F.col("a.report_id").alias("report_a"), F.col("b.report_id").alias("report_b"), (F.col("a.status") == F.col("b.status")).cast("double").alias("agreement"))


def branch_scores(reports: DataFrame, papers: DataFrame) -> DataFrame:
    """The weighted score of each report and its rank in its paper; a failed one (failed status or no text) scores 0.

    Agreement is the share of a report's distinct words that the paper's other reports have. It is counted per
    (paper, word), so long texts and many branches add partial counts only.
    """
    text = F.coalesce("full_pdf_text", F.lit(""))
    failed = (F.coalesce("status", F.lit("")) == "fail") | (F.trim(text) == "")
    heading = text.rlike(r"(?m)^\s*\d+\.?\s+[A-Z]") | text.rlike(r"(?m)^\s*[A-Z][A-Z ]{3,}\s*$") | text.rlike(r"(?im)^\s*(?:Abstract|Introduction|Methods|Results|Discussion|Conclusion|References)\b")
    weird = F.length(text) - F.length(F.regexp_replace(text, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f�￰-￿]", ""))
    base = reports.join(papers.select("paper_id", "n_pages").dropDuplicates(["paper_id"]), "paper_id", "left")
    with_text = F.size(F.filter(F.coalesce("page_texts", F.array().cast("array<struct<page:int,page_text:string>>")), lambda p: F.trim(F.coalesce(p["page_text"], F.lit(""))) != ""))
    facts = base.select(
        "paper_id", "report_id", "source", failed.alias("failed"),
        F.when(F.col("n_pages") > 0, F.least(with_text / F.col("n_pages"), F.lit(1.0))).otherwise(0.0).alias("page_coverage"),
        heading.cast("double").alias("structure"), F.length(text).between(500, 200_000).cast("double").alias("plausible"),
        F.when(F.length(text) > 0, weird / F.length(text)).otherwise(1.0).alias("weird"),
    )
    own = reports.select("paper_id", "report_id", F.explode(F.array_distinct(T.words(F.lower(text)))).alias("word"))
    shared = own.groupBy("paper_id", "word").agg(F.count("*").alias("n"))
    words = own.join(shared, ["paper_id", "word"]).groupBy("paper_id", "report_id").agg(F.count("*").alias("own"), F.count(F.when(F.col("n") > 1, 1)).alias("common"))
    others = words.groupBy("paper_id").agg(F.count("*").alias("branches"))
    agree = words.join(others, "paper_id").select("report_id", F.when(F.col("branches") == 1, 1.0).otherwise(F.col("common") / F.col("own")).alias("agreement"))
    rows = facts.join(agree, "report_id", "left").withColumn("agreement", F.coalesce("agreement", F.lit(0.0)))
    total = 0.30 + 0.25 * F.col("page_coverage") + 0.10 * F.col("structure") + 0.10 * F.col("plausible") + 0.10 * (1.0 - F.col("weird")) + 0.15 * F.col("agreement")
    scored = rows.select("paper_id", "report_id", "source", F.round(F.when(F.col("failed"), 0.0).otherwise(total), 9).alias("composite"))
    w = Window.partitionBy("paper_id").orderBy(F.desc("composite"), "report_id")
    return scored.withColumn("place", F.row_number().over(w))


def exact_agreement(primary: DataFrame, candidate: DataFrame) -> DataFrame:
    """Sentences (paper_id, sentence) matched one to one by equality: the multiset intersection, and the rate by primary sentences."""
    a = primary.groupBy("paper_id", "sentence").agg(F.count("*").alias("n_a"))
    b = candidate.groupBy("paper_id", "sentence").agg(F.count("*").alias("n_b"))
    both = a.join(b, ["paper_id", "sentence"], "full")
    na, nb = F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))
    return both.groupBy("paper_id").agg(F.sum(na).alias("n_primary"), F.sum(nb).alias("n_candidate"), F.sum(F.least(na, nb)).alias("n_exact")).withColumn(
        "agreement_rate", F.when(F.col("n_primary") > 0, F.col("n_exact") / F.col("n_primary")).otherwise(0.0)
    )


def zipped(left: DataFrame, right: DataFrame) -> DataFrame:
    """The i-th sentence of one branch beside the i-th of the other (paper_id, ord, sentence), as far as both go."""
    w = Window.partitionBy("paper_id").orderBy("ord")
    a = left.withColumn("place", F.row_number().over(w)).select("paper_id", "place", F.col("sentence").alias("left_sentence"))
    b = right.withColumn("place", F.row_number().over(w)).select("paper_id", "place", F.col("sentence").alias("right_sentence"))
    return a.join(b, ["paper_id", "place"])


def near_agreement(primary: DataFrame, candidate: DataFrame, threshold: float = 0.85) -> DataFrame:
    """``paper_id`` with counts of sentences (paper_id, ord, sentence) matched exactly and nearly, unmatched ones and the rate.

    Each primary sentence in order takes the first equal candidate that is free, else the free one most like it, if that is at least
    ``threshold`` alike; what one takes is gone for the next, so a paper's sentences are matched in one place. Equal
    sentences are found by a table, likeness is asked only where lengths and letters allow it to reach the threshold.
    """
    shape = "paper_id string, n_primary int, n_candidate int, n_exact int, n_near int, agreement_rate double"

    def match(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        left, right = (x.sort_values(f"{c}_ord")[f"{c}_sentence"].tolist() for c, x in (("a", a), ("b", b)))
        free: dict[str, list[int]] = {}
        for i, s in enumerate(right):
            free.setdefault(s, []).append(i)
        taken, exact, near = set(), 0, 0
        letters = [Counter(s) for s in right]
        for s in left:
            own = [i for i in free.get(s, ()) if i not in taken]
            if own:
                taken.add(own[0])
                exact += 1
                continue
            best, at, mine = 0.0, -1, Counter(s)
            for i, t in enumerate(right):
                total = len(s) + len(t)
                # No likeness is above what the shared letters allow.
                if i in taken or not total or 2 * sum((mine & letters[i]).values()) / total < max(threshold, best):
                    continue
                x = difflib.SequenceMatcher(None, s, t).ratio()
                if x > best:
                    best, at = x, i
            if at >= 0 and best >= threshold:
                taken.add(at)
                near += 1
        return pd.DataFrame([(key[0], len(left), len(right), exact, near, (exact + near) / len(left) if left else 0.0)], columns=[c.split()[0] for c in shape.split(", ")])

    # Columns of their own for either side, as both may come from one table.
    rows = [df.filter("paper_id is not null").select(*[F.col(c).alias(f"{side}_{c}") for c in ("paper_id", "ord", "sentence")]) for side, df in (("a", primary), ("b", candidate))]
    return rows[0].groupBy("a_paper_id").cogroup(rows[1].groupBy("b_paper_id")).applyInPandas(match, shape)


def until_verified(checks: DataFrame) -> DataFrame:
    """The checks (paper_id, ord, verified) of a paper in order up to the first that is verified, which is the last made."""
    first = checks.filter("verified").groupBy("paper_id").agg(F.min("ord").alias("stop"))
    return checks.join(first, "paper_id", "left").filter(F.col("stop").isNull() | (F.col("ord") <= F.col("stop"))).drop("stop")


def verification_status(score: Column, threshold: float, available: Column, mode: str = "skip") -> Column:
    """What a semantic check says: a candidate match, none, or what ``mode`` (skip, fail, degrade) makes of a missing index."""
    if mode not in ("skip", "fail", "degrade"):
        raise ValueError(f"no mode {mode!r}")
    missing = {"skip": "skipped", "fail": "error", "degrade": "degraded"}[mode]
    return F.when(~available, missing).when(score >= threshold, "candidate_match").otherwise("no_match")


def rationale(scored: DataFrame, failed: DataFrame, preferred: str = "grobid") -> DataFrame:
    """``paper_id``, ``report_id`` of the best branch and why it, rather than the preferred one, was taken.

    ``scored`` is that of ``branch_scores``; ``failed`` (report_id, failed, empty) says which branches gave nothing.
    """
    best = scored.filter("place = 1").select("paper_id", "report_id", "source", "composite")
    own = scored.filter(F.lower("source") == preferred).join(failed, "report_id", "left").groupBy("paper_id").agg(F.min_by(F.struct("composite", "failed", "empty"), "place").alias("p"))
    both = best.join(own, "paper_id", "left")
    name, p = F.lit(preferred.upper()), F.col("p")
    score = lambda c: F.format_string("%.3f", c)
    reason = (
        F.when(F.lower("source") == preferred, F.concat(name, F.lit(" selected as primary (composite="), score(F.col("composite")), F.lit(")")))
        .when(p.isNull(), F.concat("source", F.lit(" selected as primary (composite="), score(F.col("composite")), F.lit("); no "), name, F.lit(" branch available")))
        .when(p["empty"], F.concat("source", F.lit(" selected as primary: "), name, F.lit(" branch empty")))
        .when(p["failed"], F.concat("source", F.lit(" selected as primary: "), name, F.lit(" branch failed")))
        .otherwise(F.concat("source", F.lit(" selected as primary: "), name, F.lit(" quality score below threshold ("), name, F.lit(" composite="), score(p["composite"]), F.lit(", "), "source", F.lit(" composite="), score(F.col("composite")), F.lit(")")))
    )
    return both.select("paper_id", "report_id", reason.alias("rationale"))
