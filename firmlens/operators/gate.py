"""The whole assessment of a partner match: what a model chose, checked against the texts of both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.text import clean_text, match_text
from firmlens.operators.completion import is_specific, rationale, text_list
from firmlens.operators.matching import assess, supported


def overlap_kind(value: Column) -> Column:
    """What the two have in common, in one of the usual words where it means one; mixed where nothing is said."""
    t = match_text(value)
    return (
        F.when(t.isin("audience", "buyer", "target audience"), "audience").when(t.isin("use case", "usecase"), "use_case").when(t.isin("workflow", "process"), "workflow")
        .when(t.isin("mixed", "audience use case", "audience workflow", ""), "mixed").otherwise(t))


def target_texts(segments: Column, products: Column, selling_points: Column, industry: Column, business_model: Column) -> Column:
    """A company's texts that evidence may rest on: audience, use case, industry, business model."""
    joined = lambda *lists: clean_text(F.array_join(F.concat(*[text_list(x) for x in lists]), "; "))
    return F.array(joined(segments), joined(products, selling_points), clean_text(industry), clean_text(business_model))


def backed(evidence: Column, features: Column, texts: Column) -> Column:
    """The evidence that the texts support; without any, the first two of the rationale's features that they do."""
    given = F.filter(F.transform(F.coalesce(evidence, F.array().cast("array<string>")), lambda x: clean_text(x)), lambda x: x != "")
    own = F.filter(given, lambda x: supported(x, texts))
    return F.when(F.size(own) > 0, own).otherwise(F.slice(F.filter(rationale(features), lambda x: supported(x, texts)), 1, 2))


def match_assessment(rows: DataFrame) -> DataFrame:
    """rows with decision, reason, match_confidence, overlap_type, target_evidence and partner_evidence.

    rows has a model's choice (matched_partner_name, match_confidence, match_score, overlap_type, match_rationale_features,
    target_evidence, partner_evidence), the texts of both sides (target_texts, partner_texts: arrays), whether the chosen
    partner is known (partner_known) and its place in the shortlist (shortlist_score, shortlist_overlap_features). Evidence
    and overlap stay empty where no partner is chosen or known. A runner-up's columns, and all others, pass through. Null in
    any column counts as nothing said; rows stay as they are.
    """
    features = rationale(F.col("match_rationale_features"))
    nothing = F.array().cast("array<string>")
    rows = rows.withColumns({"_target": backed(F.col("target_evidence"), features, F.coalesce("target_texts", nothing)), "_partner": backed(F.col("partner_evidence"), features, F.coalesce("partner_texts", nothing))})
    known = F.coalesce("partner_known", F.lit(False))
    shared = F.size(F.filter(F.transform(F.coalesce("shortlist_overlap_features", nothing), lambda x: clean_text(x)), lambda x: x != ""))
    verdict = assess(
        F.col("matched_partner_name"), F.col("match_confidence"), F.col("match_score"), known, F.size("_target") > 0, F.size("_partner") > 0, F.coalesce(F.col("shortlist_score").cast("double"), F.lit(0.0)), shared,
        F.size(F.filter(features, is_specific)))
    rows = rows.withColumn("_v", verdict)
    checked = ~F.col("_v.reason").isin("missing_partner_match_output", "missing_partner_name", "explicit_no_match", "matched_partner_data_missing")
    out = {
        "decision": F.col("_v.decision"), "reason": F.col("_v.reason"), "match_confidence": F.col("_v.confidence"), "overlap_type": F.when(checked, overlap_kind(F.col("overlap_type"))),
        "target_evidence": F.when(checked, F.col("_target")).otherwise(nothing), "partner_evidence": F.when(checked, F.col("_partner")).otherwise(nothing),
    }
    return rows.withColumns(out).drop("_target", "_partner", "_v")

